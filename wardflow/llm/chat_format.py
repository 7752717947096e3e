"""Chat formatting of typed content parts.

A message is a list of parts: text, image, audio, document or any other file.  A
visitor has one method per kind, a SQL expression that turns a part into flat
text and a number of tokens: text is escaped, an attachment becomes a placeholder
that stands for as many tokens as its size asks for.  The order of the
placeholders is the order of the attachments, whose kind, label and reference
are recorded beside the text.  Messages that hold plain text are cut at inline
attachments, ``![image 640x480](reference)``, so nothing of them is lost.

A turn is ``<s>[INST] role [/INST] body</s>``.  Control strings in roles and texts
get a backslash after their first character, those that have backslashes there
already one more, so removing one backslash from each gives the text back and no
text can pretend to be a turn or a placeholder.  The loss mask has one span per
assistant turn: its body, nothing of the markers.

Turns are formatted one row at a time.  Only ``conversations`` brings the turns of
one conversation together, since its result is one string each; a conversation's
rows then have to fit into one task.  All steps are SQL expressions.

Cases: null roles, texts and part lists are empty; a null kind is text, an unknown
one a file; null part texts, labels and references are empty; turns come in order
of ``turn`` (nulls first), those of one number in order of their formatted text;
repeated rows are repeated turns; rows without an id are one conversation; extra
columns are not read; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

TURN, SAYS, END = "<s>[INST] ", " [/INST] ", "</s>"
KINDS = ("image", "audio", "document", "file")
#: A part with its type; text parts fill ``text``, attachments ``label`` (their size, as far as known) and ``ref``.
PART = "struct<kind:string,text:string,label:string,ref:string>"

_ANGLE, _SQUARE = r"/?s>", rf"(?:/?INST|{'|'.join(k.upper() for k in KINDS)})\]"
_INLINE = rf"!\[({'|'.join(KINDS)})([^\[\]\n]*)\]\(([^()\s]*)\)"
_PLACEHOLDER = rf"\[(?:{'|'.join(k.upper() for k in KINDS)})\]"
#: Words and single marks count one token each.
_TOKEN = r"[A-Za-z0-9]+|[^A-Za-z0-9\x09-\x0D\x20]"

PATCH, IMAGE_TOKENS = 28, 256
TOKENS_PER_SECOND, AUDIO_SECONDS = 25, 30
TOKENS_PER_PAGE = 500


def escape(text: Column) -> Column:
    """No control string is left; a backslash more in each."""
    text = F.regexp_replace(text, rf"(<)(\\*{_ANGLE})", r"$1\\$2")
    return F.regexp_replace(text, rf"(\[)(\\*{_SQUARE})", r"$1\\$2")


def unescape(text: Column) -> Column:
    text = F.regexp_replace(text, rf"(<)\\(\\*{_ANGLE})", "$1$2")
    return F.regexp_replace(text, rf"(\[)\\(\\*{_SQUARE})", "$1$2")


def part(kind: Column, text: Column, label: Column, ref: Column) -> Column:
    return F.struct(kind.alias("kind"), text.alias("text"), label.alias("label"), ref.alias("ref"))


def inline_parts(text: Column) -> Column:
    """The parts of a plain text: its inline attachments and what lies between them."""
    none = F.lit("")
    pieces, found = F.split(text, _INLINE, -1), F.regexp_extract_all(text, F.lit(_INLINE), F.lit(0))
    group = lambda x, i: F.regexp_extract(x, _INLINE, i)
    texts = F.transform(pieces, lambda x: part(F.lit("text"), x, none, none))
    files = F.transform(found, lambda x: part(group(x, 1), none, group(x, 2), group(x, 3)))
    pairs = F.flatten(F.zip_with(texts, files, lambda a, b: F.array(a, b)))
    return F.filter(pairs, lambda p: p.isNotNull() & ((p["kind"] != "text") | (p["text"] != "")))


def inline(kind: Column, label: Column, ref: Column) -> Column:
    """The inline form of an attachment."""
    return F.concat(F.lit("!["), kind, label, F.lit("]("), ref, F.lit(")"))


def tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(_TOKEN)).cast("long")


def _number(label: Column, pattern: str) -> Column:
    return F.regexp_extract(label, pattern, 1).try_cast("double")


def visit_text(p: Column) -> tuple[Column, Column]:
    return escape(p["text"]), tokens(p["text"])


def visit_image(p: Column) -> tuple[Column, Column]:
    """One token per patch of the stated width and height."""
    side = lambda i: F.ceil(F.regexp_extract(p["label"], r"([0-9]{1,6})x([0-9]{1,6})", i).try_cast("double") / PATCH)
    return F.lit("[IMAGE]"), F.coalesce(side(1) * side(2), F.lit(IMAGE_TOKENS))


def visit_audio(p: Column) -> tuple[Column, Column]:
    return F.lit("[AUDIO]"), F.ceil(F.coalesce(_number(p["label"], r"([0-9]{1,9}(?:\.[0-9]{1,6})?)s"), F.lit(float(AUDIO_SECONDS))) * TOKENS_PER_SECOND)


def visit_document(p: Column) -> tuple[Column, Column]:
    return F.lit("[DOCUMENT]"), F.ceil(F.coalesce(_number(p["label"], r"([0-9]{1,9})p"), F.lit(1.0)) * TOKENS_PER_PAGE)


def visit_file(p: Column) -> tuple[Column, Column]:
    return F.lit("[FILE]"), F.lit(1)


VISITOR: dict[str, Callable[[Column], tuple[Column, Column]]] = {
    "text": visit_text, "image": visit_image, "audio": visit_audio, "document": visit_document, "file": visit_file,
}


def visit(p: Column, visitor: dict[str, Callable]) -> Column:
    """struct(kind, label, ref, flat, tokens) of a part by the visitor's method for its kind, that for files if it has none."""
    flat, size = visitor["file"](p)
    size = size.cast("long")
    for kind, method in visitor.items():
        f, s = method(p)
        flat, size = F.when(p["kind"] == kind, f).otherwise(flat), F.when(p["kind"] == kind, s.cast("long")).otherwise(size)
    return F.struct(p["kind"].alias("kind"), p["label"].alias("label"), p["ref"].alias("ref"), flat.alias("flat"), size.alias("tokens"))


def _whole(parts: Column) -> Column:
    """The parts without nulls, of known kinds."""
    text = lambda p, c: F.coalesce(p[c], F.lit(""))
    kind = lambda p: F.when(F.coalesce(p["kind"], F.lit("text")).isin(*VISITOR), F.coalesce(p["kind"], F.lit("text"))).otherwise("file")
    known = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    return F.transform(known, lambda p: part(kind(p), text(p, "text"), text(p, "label"), text(p, "ref")))


def turns(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", parts: str | None = None, visitor: dict[str, Callable] = VISITOR) -> DataFrame:
    """One formatted turn per row: (conv_id, turn, formatted, body_at, body_chars, learn, attachments, n_tokens).

    ``parts`` names a column of typed parts; without it the parts are those of the plain text.
    """
    content = _whole(F.col(parts)) if parts else inline_parts(F.coalesce(F.col(text).cast("string"), F.lit("")))
    rows = messages.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        content.alias("parts"),
    )
    rows = rows.select("*", F.transform("parts", lambda p: visit(p, visitor)).alias("flat")).select(
        "*", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(SAYS)).alias("head"), F.array_join(F.col("flat.flat"), "").alias("body"))
    # Four control strings frame a turn.
    size = F.aggregate("flat.tokens", tokens(F.col("role")) + 4, lambda a, x: a + x)
    return rows.select(
        "conv_id", "turn", F.concat("head", "body", F.lit(END)).alias("formatted"), F.length("head").cast("long").alias("body_at"),
        F.length("body").cast("long").alias("body_chars"), (F.col("role") == "assistant").alias("learn"),
        F.transform(F.filter("flat", lambda p: p["kind"] != "text"), lambda p: F.struct(*[p[c].alias(c) for c in ("kind", "label", "ref", "tokens")])).alias("attachments"),
        size.alias("n_tokens"),
    )


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss, attachments, n_tokens): the rows of ``turns``, one string per conversation.

    ``loss`` lists the learnt spans as (turn, start, length), by 0-based turn and code
    points within it; ``attachments`` has one list per turn.
    """
    order = ["turn", "formatted", "body_at", "body_chars", "learn", "attachments", "n_tokens"]
    held = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(*order))).alias("t"))
    spans = F.transform("t", lambda t, i: F.when(t["learn"], F.struct(i.alias("turn"), t["body_at"].alias("start"), t["body_chars"].alias("length"))))
    return held.select(
        "conv_id", F.array_join("t.formatted", "").alias("formatted"), F.array_compact(spans).alias("loss"), F.col("t.attachments").alias("attachments"),
        F.aggregate("t.n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_tokens"),
    )


def plain(body: Column, attachments: Column) -> Column:
    """The plain text of a formatted body: unescaped, its placeholders as inline attachments."""
    texts = F.transform(F.split(body, _PLACEHOLDER, -1), unescape)
    return F.array_join(F.flatten(F.zip_with(texts, attachments, lambda x, a: F.array(x, inline(a["kind"], a["label"], a["ref"])))), "")


def read_back(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, learnt, attachments, n_tokens): what the formatted strings of ``conversations`` say.

    ``turns`` lists (role, text); ``learnt`` the texts under the loss mask.
    """
    cut = F.split("formatted", F.lit(END), -1)
    rows = rows.withColumn("_cut", F.slice(cut, F.lit(1), F.size(cut) - 1))
    halves = lambda s: F.split(F.substring(s, F.lit(len(TURN) + 1), F.length(s)), r" \[/INST\] ", 2)
    said = lambda h, a: F.struct(unescape(h[0]).alias("role"), plain(h[1], a).alias("text"))
    read = F.zip_with(F.transform("_cut", halves), "attachments", said)
    learnt = F.transform("loss", lambda m: plain(F.substring(F.get(F.col("_cut"), m["turn"]), (m["start"] + 1).cast("int"), m["length"].cast("int")), F.get(F.col("attachments"), m["turn"])))
    return rows.select("conv_id", "formatted", read.alias("turns"), learnt.alias("learnt"), "attachments", "n_tokens")
