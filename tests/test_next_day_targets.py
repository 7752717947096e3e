"""Next-day targets against a plain version, and how their children are formed."""

import random

from wardflow.operators import timeline as T, timeline_features as S

EDGES = [("a", "r"), ("b", "r"), ("c", "a"), ("d", "a"), ("d", "b"), ("e", "b"), ("f", "b"), ("c", "a"), ("x", "a")]
VALID = {"a": 0, "b": 1, "c": 2, "d": 3, "e": 4, "f": 5}
UP = {"a": "ar", "b": "br", "c": "car", "d": "dabr", "e": "ebr", "f": "fbr", "x": "xar", "r": "r"}


def made(spark):
    rnd = random.Random(5)
    held = {(p, a): set("".join(UP[c] for c in rnd.sample("cdefx", rnd.randint(1, 3)))) for p in range(6) for a in rnd.sample(range(30), 5)}
    days = [(p, a, sorted(b for q, b in held if q == p).index(a)) for p, a in held]
    frame = spark.createDataFrame
    found = S.next_day_targets(
        frame(days, "person_id long, age int, day_index int"), frame([(p, a, c) for (p, a), s in held.items() for c in s], "person_id long, age int, code string"),
        frame(EDGES, "code string, parent string"), frame(list(VALID.items()), "code string, valid_index long"))
    return held, days, found


def test_targets_equal_a_plain_version(spark):
    held, days, found = made(spark)
    want = []
    for p, a, i in days:
        if i > 0:
            kids = {c for c, parent in EDGES if parent in held[p, a]} - held[p, a]
            for target, codes in ((1, held[p, a]), (0, kids)):
                want += [(p, i - 1, VALID[c], target, int(any(q == p and b < a and c in s for (q, b), s in held.items()))) for c in codes if c in VALID]
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_children_are_neither_dealt_nor_sorted(spark):
    plan = made(spark)[2]._jdf.queryExecution().executedPlan().toString()
    children = plan.split("Generate explode(_kids", 1)
    assert len(children) == 2 and "Exchange" not in children[0] and "Sort " not in children[0]


def test_dictionary_of_some_codes(spark):
    events = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("c",), ("c",)], "code string")
    some = spark.createDataFrame([("a",), ("b",), ("b",)], "code string")
    assert sorted(map(tuple, T.code_dictionary(events, some).select("code", "n", "code_id").collect())) == [("a", 1, 1), ("b", 2, 0)]
