"""Conversation repair against enumeration of all edits, split pieces, and the defined cases."""

import hashlib
import itertools
import random
import re

import pytest

from wardflow.llm import dialogue_repair as dr

MESSAGE = "conv_id long, turn long, role string, text string"
SOUND = re.compile(r"(s?(ua)+)?")


def test_query_matches_sql(same_as_sql):
    same_as_sql("op11_dialogue_repair")


def cheapest(codes: str) -> tuple[int, str]:
    """(cost, audit) by trying every edit of every row and up to two inserts at every place."""
    best = None
    gaps = ["", "u", "a", "ua", "au"]
    options = [["D"] if c == "x" else ["D", "K", "Ru", "Ra"] for c in codes]
    for row in itertools.product(*options):
        for put in itertools.product(gaps, repeat=len(codes) + 1):
            cost, audit, initials = 0, "", ""
            for i, e in enumerate([*row, ""]):
                audit, initials, cost = audit + "I" * len(put[i]), initials + put[i], cost + 2 * len(put[i])
                if e:
                    audit += e[0]
                    cost += {"D": 3, "K": 0, "R": 2}[e[0]] + (e != "D" and codes[i].isupper())
                    initials += "" if e == "D" else e[1] if e[0] == "R" else codes[i].lower()
            if SOUND.fullmatch(initials) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def whole(codes: str) -> tuple[int, str]:
    way = dr.search(codes, 0, tuple(c for c, _ in dr.FINISH))
    return way.cost + dr.FINISH[way.state][0], way.edits + dr.FINISH[way.state][1]


def test_search_matches_enumeration():
    for n in (1, 2):
        for codes in itertools.product("xsuaoSUA", repeat=n):
            assert whole("".join(codes)) == cheapest("".join(codes)), codes
    rng = random.Random(1)
    for _ in range(60):
        codes = "".join(rng.choice("xsuaoUAuaua") for _ in range(3))
        assert whole(codes) == cheapest(codes), codes


def test_pieces_give_what_the_whole_gives():
    rng = random.Random(2)
    for _ in range(150):
        codes = "".join(rng.choice("xsuaoUAuauaua") for _ in range(rng.randint(1, 60)))
        size = rng.randint(1, 9)
        cut = [codes[i:i + size] for i in range(0, len(codes), size)]
        rest, rests = tuple(c for c, _ in dr.FINISH), []
        for p in reversed(cut):
            rests.append(rest)
            rest = dr.before(dr.ways(p), rest)
        state, audit, cost = 0, "", 0
        for p, r in zip(cut, reversed(rests)):
            way = dr.search(p, state, r)
            state, audit, cost = way.state, audit + way.edits, cost + way.cost
            assert way.cost == dr.price(p, way.edits, [1] * len(p))
        assert (cost + dr.FINISH[state][0], audit + dr.FINISH[state][1]) == whole(codes)
        assert rest[0] == cost + dr.FINISH[state][0]


def test_bound_is_never_over_the_cost():
    rng = random.Random(3)
    for _ in range(300):
        codes = "".join(rng.choice("xsuaoSUA") for _ in range(6))
        low = dr.bounds(codes)
        for q in range(4):
            way = dr.search(codes, q, (0, 0, 0, 0))
            assert low(0, q) <= way.cost


def table(spark, rows):
    """The rows with extra columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], MESSAGE + ", kind int, digest string, edits string, place int")


def random_rows(seed: int, conversations: int, most: int) -> list[tuple]:
    rng = random.Random(seed)
    texts = ["Fine.", "Good!", "Why?", "broken", "  ", "", "Fine. \n", "x.", "y.", "z."]
    return [(c, rng.choice([None, *range(most)]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]), rng.choice(texts))
            for c in range(conversations) for _ in range(rng.randint(0, most))]


@pytest.fixture(scope="module")
def repaired(spark):
    rows = random_rows(4, 30, 20)
    return rows, {r.conv_id: r for r in dr.report(table(spark, rows)).collect()}


def plain(rows: list[tuple]) -> dict:
    """The report of one conversation by loops."""
    md5 = lambda x: hashlib.md5(x.encode()).digest()
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), md5(r[3])))
    seen, codes, out = set(), "", dict(blank=0, duplicate=0, truncated=0)
    for _, _, role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
        seen.add((role, text))
        if fault:
            out[fault] += 1
        code = role[:1] if role[:1] in ("s", "u", "a") and role else "o"
        codes += "x" if fault in ("blank", "duplicate") else code.upper() if fault else code
    turns = [r[1] for r in rows if r[1] is not None]
    out["gaps"] = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    out["illegal"] = sum((a[2][:1] + b[2][:1]) not in dr.LEGAL for a, b in zip(rows, rows[1:]))
    out["cost"], out["audit"] = whole(codes)
    lines, at, state = [], 0, ""
    for e in out["audit"]:
        role = "assistant" if state == "u" else "user"
        if e == "I":
            lines.append(f"{role}:")
        else:
            if e != "D":
                lines.append(f"{role if e == 'R' else rows[at][2]}:{rows[at][3]}")
            at += 1
        if e != "D":
            state = lines[-1][0]
    out["repaired_sha256"] = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return out


def test_report_matches_loops(repaired):
    rows, got = repaired
    assert set(got) == {r[0] for r in rows}
    for c, r in got.items():
        want = plain([x for x in rows if x[0] == c])
        assert {k: r[k] for k in want} == want, c


def test_small_pieces_over_many_partitions_give_the_same(spark, repaired):
    rows, got = repaired
    done = dr.repair(table(spark, rows).repartition(7), piece=2)
    for r in done.audits().collect():
        assert (r.cost, r.illegal, r.audit, r.repaired_sha256) == tuple(got[r.conv_id][k] for k in ("cost", "illegal", "audit", "repaired_sha256"))


def test_edited_rows(spark, repaired):
    rows, got = repaired
    edits = {}
    for r in dr.repair(table(spark, rows)).rows().orderBy("conv_id", "place").collect():
        edits.setdefault(r.conv_id, []).append(r)
    for c, steps in edits.items():
        assert [s.place for s in steps] == list(range(len(steps))) and "".join(s.edit for s in steps) == got[c].audit
        kept = [f"{s.role}:{s.text}" for s in steps if s.role is not None]
        assert SOUND.fullmatch("".join(k[0] for k in kept))
        assert hashlib.sha256("\n".join(kept).encode()).hexdigest() == got[c].repaired_sha256


def test_defined_cases(spark):
    rows = [(None, None, None, None), (None, 1, "user", "a."), (7, None, "user", None), (8, 2, "user", "Hi."), (8, 2, "user", "Hi."), (8, 2, "user", "Hi."), (9, 1 << 62, "user", "Hi."), (9, -(1 << 62), "user", "Ho.")]
    got = {r.conv_id: r for r in dr.report(table(spark, rows)).collect()}
    assert (got[None].blank, got[None].audit, got[None].cost) == (1, "DKI", 5)
    assert (got[7].blank, got[7].gaps, got[7].audit, got[7].cost) == (1, 0, "D", 3)
    assert (got[8].duplicate, got[8].illegal, got[8].audit, got[8].cost) == (2, 2, "DDD", 9) or (got[8].audit, got[8].cost) == ("KDDI", 8)
    assert got[9].gaps == (1 << 63) - 1 and got[9].audit in ("KIKI", "KR", "DKI")
    assert dr.report(spark.createDataFrame([], MESSAGE)).count() == 0


def test_one_long_conversation(spark):
    rng = random.Random(6)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"Text {t}.") for t in range(3000)] + [(1, 3000, "user", "Same.")] * 500
    got = dr.report(table(spark, rows)).first()
    assert len(got.audit) >= 3500 and got.audit.count("D") >= 499 and got.duplicate == 499 and got.cost < 3 * 3500


def test_long_text(spark):
    text = "A very long text. " * 200_000
    got = dr.report(table(spark, [(1, 0, "user", text), (1, 1, "assistant", text)])).first()
    assert got.audit == "KK" and got.repaired_sha256 == hashlib.sha256(f"user:{text}\nassistant:{text}".encode()).hexdigest()
