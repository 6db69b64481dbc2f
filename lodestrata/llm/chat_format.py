"""Chat formatting by black-box rendering: a template is only ever called, never parsed.

Successive prefixes of a conversation are rendered and consecutive outputs compared: what the longer
one adds is the new turn's span. Where the turn's own text stands in it is found by rendering the same
prefix with two other texts that differ in one character. A template whose longer output does not
go on from the shorter one rewrites history, and is reported as such.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.work import short_batches, stored
from lodestrata.operators.numbering import numbered

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

SECTION = 64  # turns of a long conversation that are rendered together
_OUT = 1 << 20  # characters of an output batch, about
CONTEXT = 2  # turns before a section that are rendered with it

TURN = "struct<role string, formatted string, content_start int, content_end int, loss boolean, rewrites boolean>"

# ---- the default template

_NAMES = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}
_ROLES = {v: k for k, v in _NAMES.items()}
_CONTROL = re.compile(r"\\|###|</turn>")
_IN_ROLE = re.compile(r"\\|###|</turn>|:|=")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:|=)")
_HEADER = re.compile(r"((?:[^\\:]|\\.)*): ", re.S)
_MARK = re.compile(r"\\(?:\\|###|</turn>|:|=)|### | </turn>\n")


def _escape(control: re.Pattern, text: str) -> str:
    return control.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def marked_turns(turns: list[Turn]) -> str:
    """Turns between marks. A backslash stands before control strings and backslashes of a text; a role other than the usual four is written as =role."""
    return "".join(f"### {_NAMES.get(role) or '=' + _escape(_IN_ROLE, role)}: {_escape(_CONTROL, text)} </turn>\n" for role, text in turns)


def read_marked_turns(formatted: str) -> list[Turn]:
    """The turns of an output of ``marked_turns``, from its marks alone."""
    turns, start = [], 0
    for m in _MARK.finditer(formatted):
        if m.group() == "### ":
            start = m.end()
        elif m.group() == " </turn>\n":
            head = _HEADER.match(formatted, start)
            name = head[1]
            turns.append((unescape(name[1:]) if name.startswith("=") else _ROLES[name], unescape(formatted[head.end() : m.start()])))
    return turns


# ---- locating turns in the outputs of any template


def _common(a: str, b: str) -> int:
    """Length of the common start of two strings."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _common_end(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[len(a) - mid : len(a) - low] == b[len(b) - mid : len(b) - low]:
            low = mid
        else:
            high = mid - 1
    return low


def located(render: Template, turns: list[Turn], skip: int = 0) -> list[dict]:
    """Formatted text and spans of the turns after the first ``skip``, which are context only.

    Per turn: ``formatted`` (what it adds to the output), ``content_start`` and ``content_end`` (its
    text there; null if the template does not keep a turn's surroundings when its text changes), and
    ``rewrites``. An end that every output has, such as a closing mark, is with the last turn;
    its first characters count to the turn before where a turn's header begins with the same ones.
    A turn that rewrites history has its whole prefix as ``formatted``.
    """
    before, out = render(turns[:skip]) if skip else "", []
    for k in range(skip, len(turns)):
        role, past = turns[k][0], turns[:k]
        now = render(turns[: k + 1])
        one, two = render([*past, (role, "a")]), render([*past, (role, "b")])
        head, foot = _common(one, two), _common_end(one, two)
        kept = len(now) >= head + foot and now[:head] == one[:head] and now[len(now) - foot :] == one[len(one) - foot :]
        start, end = (head, len(now) - foot) if kept else (None, None)

        same = _common(before, now)
        closing = before[same:]  # stands at the end of both outputs, unless history is rewritten
        goes_on = now.endswith(closing) and len(now) >= same + len(closing) and (not out or same >= out[-1]["_end"])
        cell = {"formatted": now, "content_start": start, "content_end": end, "rewrites": k > 0 and not goes_on, "_end": end or 0}
        if not cell["rewrites"]:
            if out and not out[-1]["rewrites"]:
                out[-1]["formatted"] = out[-1]["formatted"].removesuffix(closing)
            inside = start is not None and start >= same
            cell |= {"formatted": now[same:], "content_start": start - same if inside else None, "content_end": end - same if inside else None}
        out.append(cell)
        before = now
    return out


def _sections(conversations: DataFrame) -> DataFrame:
    """(conv_id, section, sections, context, turn, role, text): conversations whole, or in sections of SECTION turns where they have more."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    long = stored(rows.groupBy("conv_id").agg(F.count("*").alias("_n")).filter(F.col("_n") > SECTION).withColumnRenamed("conv_id", "_c"), "long")
    match = rows["conv_id"].eqNullSafe(long["_c"])
    short = rows.join(long, match, "left_anti").select("conv_id", F.lit(0).cast("long").alias("section"), F.lit(1).cast("long").alias("sections"), F.lit(False).alias("context"), "turn", "role", "text")
    if long.isEmpty():
        return short
    # A long conversation's turns are numbered by ranges, so none is one task; only these rows are shuffled for it.
    placed = stored(numbered(rows.join(long, match).drop("_c"), ["conv_id", "turn", "role", "text"], "_no"), "placed")
    first = stored(placed.groupBy("conv_id").agg(F.min("_no").alias("_first")).withColumnRenamed("conv_id", "_c"), "first")
    placed = placed.join(first, placed["conv_id"].eqNullSafe(first["_c"])).withColumn("_at", F.col("_no") - F.col("_first"))
    own = F.expr(f"_at div {SECTION}")
    leads = (F.col("_at") % SECTION >= SECTION - CONTEXT) & (F.expr(f"(_n - 1) div {SECTION}") > own)
    to = F.when(leads, F.array(F.struct(own.alias("s"), F.lit(False).alias("c")), F.struct((own + 1).alias("s"), F.lit(True).alias("c")))).otherwise(F.array(F.struct(own.alias("s"), F.lit(False).alias("c"))))
    cut = placed.withColumn("_to", F.explode(to)).select("conv_id", F.col("_to.s").alias("section"), F.expr(f"(_n - 1) div {SECTION} + 1").alias("sections"), F.col("_to.c").alias("context"), "turn", "role", "text")
    return short.union(cut)


def format_conversations(conversations: DataFrame, render: Template = marked_turns, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Per section of a conversation: conv_id, section (from 0), sections, and ``turns`` with the formatted text and spans of each.

    The conversation's formatted text is that of its turns one after the other. ``loss`` marks turns
    of the roles in ``learn`` whose text was located. A conversation of at most 64 turns is one section,
    and each of its prefixes is rendered whole. A longer one is cut into sections of 64, rendered
    with the two turns before each, so that time grows with its length and no task holds it; a
    template then sees no more of what went before.

    Turns follow each other by turn (null first), then role and text; repeated rows are turns of
    their own. A null conv_id is a conversation, null roles and texts are empty ones. Other columns
    take no part. An empty table gives an empty result.
    """
    short_batches(conversations.sparkSession)
    rows = _sections(conversations)
    near = rows.repartition("conv_id", "section").sortWithinPartitions("conv_id", "section", "turn", "role", "text", ~F.col("context"))
    near = near.select("conv_id", "section", "sections", "context", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        made, size = [], 0
        for (conv, section), group in groupby(every, key=lambda r: r[:2]):
            group = list(group)
            turns, skip = [r[4:] for r in group], sum(r[3] for r in group)
            cells = located(render, turns, skip)
            for x, t in zip(cells, turns[skip:], strict=True):
                del x["_end"]
                x |= {"role": t[0], "loss": t[0] in learn and x["content_start"] is not None}
                size += len(x["formatted"])
            made.append({"conv_id": conv, "section": section, "sections": group[0][2], "turns": cells})
            if size > _OUT:
                yield pa.RecordBatch.from_pylist(made, schema=_SCHEMA)
                made, size = [], 0
        yield pa.RecordBatch.from_pylist(made, schema=_SCHEMA)

    return near.mapInArrow(run, f"conv_id long, section long, sections long, turns array<{TURN}>")


_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()), ("section", pa.int64()), ("sections", pa.int64()),
        ("turns", pa.list_(pa.struct([("role", pa.string()), ("formatted", pa.string()), ("content_start", pa.int32()), ("content_end", pa.int32()), ("loss", pa.bool_()), ("rewrites", pa.bool_())]))),
    ]
)


# ---- digests, read back from the formatted text


def digests(sections: DataFrame, read: Callable[[str], list[Turn]] = read_marked_turns, plain: Callable[[str], str] = unescape) -> DataFrame:
    """Per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars.

    All of it comes from the formatted text: turns by its marks, loss texts from the spans. A
    conversation of one section is digested where it stands. The sections of a longer one travel to
    one task, which takes them one at a time: a SHA-256 has no parallel form.
    """

    def in_section(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, section, n, cells in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                formatted = "".join(x["formatted"] for x in cells)
                turns = read(formatted)
                loss = [plain(x["formatted"][x["content_start"] : x["content_end"]]) for x in cells if x["loss"]]
                said, learnt = "".join(f"{r}\n{t}\n" for r, t in turns), "".join(loss)
                done = _hex(said, learnt) if n == 1 else (None, None)
                rows.append((conv, section, len(turns), *done, len(learnt), len(formatted), *((None, None) if n == 1 else (said, learnt))))
            yield _batch(rows, _PART)

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        rows = []
        for conv, group in groupby(every, key=lambda r: r[0]):
            n, chars, size, both = 0, 0, 0, (hashlib.sha256(), hashlib.sha256())
            for r in group:
                n, chars, size = n + r[2], chars + r[5], size + r[6]
                done = r[3:5]
                for h, t in zip(both, r[7:9], strict=True):
                    h.update((t or "").encode())
            rows.append((conv, n, done[0] or both[0].hexdigest(), chars, done[1] or both[1].hexdigest(), size))
            if len(rows) == 10_000:
                yield _batch(rows, _WHOLE)
                rows = []
        yield _batch(rows, _WHOLE)

    cells = sections.select("conv_id", "section", "sections", "turns")
    parts = cells.mapInArrow(in_section, "conv_id long, section long, n long, turns_sha256 string, loss_sha256 string, loss_chars long, formatted_chars long, said string, learnt string")
    near = parts.repartition("conv_id").sortWithinPartitions("conv_id", "section")
    return near.mapInArrow(in_order, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _hex(*texts: str) -> tuple[str, ...]:
    return tuple(hashlib.sha256(t.encode()).hexdigest() for t in texts)


_PART = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
_WHOLE = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]


def _batch(rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [f"c{k}" for k in range(len(types))])
