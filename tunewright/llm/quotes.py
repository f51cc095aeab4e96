"""Quotation linking: conversations in reply order, without the quotes.

A message is its own lines and quoted passages: runs of lines with the same number of ``>`` marks. A
line that only introduces a quote ("On Monday, Ann wrote:") goes with it. Passages are normalised
(case, white space, line breaks) and hashed: as a whole, by paragraph and by sentence, so that parts and
re-wrapped lines are found again. Own texts are hashed alike. A quoted hash belongs to the first
message of its conversation that says it in its own words; a passage to the earlier message that has
most of its characters (of several the latest). A message answers the source of its level-1
passages, by the same rule, and, where none was found, the message before it.

Conversations come out as rows with ``position``, gapless from 0, in reply order: a message stands
before its answers, answers to one message stand by their order, each followed by all that it led to.
Rows are numbered by sorts of ranges, so a conversation that holds a third of all rows is cut over many
tasks; places in conversations that branch come from pointers that are followed by doubling, joined
on keys that are unique. Links are joins on (conversation, hash) with one row for each hash.

A quote of words that are first said by a later message has no source: it is no answer.

Defined results: null texts are empty; rows with equal order follow each other by their texts' hash;
rows without a conversation form one of their own, rows without an order come first; repeated rows
are kept; quotes without a source are dropped from the text like others. Columns of the input that
are called like an output column are replaced (but for the text, which loses its quotes).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright.llm import words as W
from tunewright.llm.registry import query
from tunewright.session import store

_MARKS = re.compile(r"[ \t]{0,3}((?:>[ \t]?)+)")
_INTRODUCES = re.compile(
    r"(?:\b(?:wrote|writes|said|schrieb|schreibt|escribi[óo]|a écrit)\b[^\n]*:|^-+ ?original message ?-+)\s*$", re.I
)
_SENTENCE = re.compile(r"(?<=[.!?…])\s+")
_PARAGRAPH = re.compile(r"\n\s*\n")


def parse(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """A message's own text, and its quoted passages with their levels."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    last = 0
    for line in (text or "").split("\n"):
        m = _MARKS.match(line)
        level = m[1].count(">") if m else 0
        if not level:
            # one empty line where a quote went
            if line.strip() or not last or (own and own[-1].strip()):
                own.append(line)
        else:
            if not last:
                while own and not own[-1].strip():
                    own.pop()
                if own and _INTRODUCES.search(own[-1]):
                    own.pop()
            if level != last:
                passages.append((level, []))
            passages[-1][1].append(line[m.end() :])
        last = level
    found = []
    for level, lines in passages:
        # the line that introduces what a quoted message quotes itself is none of its words
        t = "\n".join(x for x in lines if not _INTRODUCES.search(x)).strip()
        if t:
            found.append((level, t))
    return "\n".join(own).strip(), found


def normalise(text: str) -> str:
    return " ".join(text.casefold().split())


def units(text: str) -> dict[int, int]:
    """Hashes of a text, its paragraphs and its sentences, with their numbers of characters."""
    from xxhash import xxh3_64_intdigest as xxh

    out = {}
    whole = normalise(text)
    parts = [whole, *_SENTENCE.split(whole)]
    for p in _PARAGRAPH.split(text):
        n = normalise(p)
        parts += [n, *_SENTENCE.split(n)]
    for p in parts:
        if p:
            h = xxh(p.encode("utf-8", "surrogatepass"))
            out[h - (1 << 64) if h >> 63 else h] = len(p)
    return out


_UNITS = pa.list_(
    pa.struct([("passage", pa.int32()), ("level", pa.int32()), ("h", pa.int64()), ("n", pa.int64())])
)
_QUOTES = pa.list_(pa.struct([("level", pa.int32()), ("text", pa.string())]))


def _parsed(text: str, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.pieces(batches):
            texts, quotes, own, asked = [], [], [], []
            for t in b.column(text).to_pylist():
                mine, passages = parse(t)
                texts.append(mine)
                quotes.append([{"level": k, "text": p} for k, p in passages])
                own.append(list(units(mine)))
                asked.append(
                    [
                        {"passage": i, "level": k, "h": h, "n": n}
                        for i, (k, p) in enumerate(passages)
                        for h, n in units(p).items()
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    *[b.column(c) for c in carried],
                    pa.array(texts, pa.string()),
                    pa.array(quotes, _QUOTES),
                    pa.array(own, pa.list_(pa.int64())),
                    pa.array(asked, _UNITS),
                ],
                names=[*carried, text, "_quotes", "_own", "_asked"],
            )

    return run


def _numbered(df: DataFrame, name: str, *by: str | Column) -> DataFrame:
    """``name``: the place of each row in the order of all rows by these columns."""
    s = df.repartitionByRange(*by).sortWithinPartitions(*by)
    # the row's place within its task, and the task
    s = store(s.withColumn("_id", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_id", 33)
    within = F.col("_id").bitwiseAND((1 << 33) - 1)
    # as many rows as there are tasks, so the sums fit in one place
    sizes = s.groupBy(part.alias("_p")).count().collect()
    before, total = [], 0
    for r in sorted(sizes, key=lambda r: r["_p"]):
        before.append((r["_p"], total))
        total += r["count"]
    offsets = df.sparkSession.createDataFrame(before, "_task bigint, _before bigint")
    s = s.join(F.broadcast(offsets), part == F.col("_task"))
    return s.withColumn(name, within + F.col("_before")).drop("_id", "_task", "_before")


def _ordered(df: DataFrame, scope: str, order: str, text: str) -> DataFrame:
    """``_g``, the place of each row in the order of all conversations, and ``_first``, that of the
    first row of its conversation."""
    s = _numbered(df, "_g", scope, order, F.xxhash64(text))
    first = s.groupBy(F.col(scope).alias("_scope")).agg(F.min("_g").alias("_first"))
    return s.join(first, F.col(scope).eqNullSafe(F.col("_scope")))


def _followed(links: DataFrame) -> DataFrame:
    """Rows ``(_v, _to, _d, _end)``, each pointer ``_to`` followed to its end by doubling: ``_end`` of the
    last row on the way, and the sum of ``_d``. A row is pointed to by one other at most, so no key
    of a join is hot, and the rounds are the logarithm of the longest way."""
    now = store(links, "pointers")
    while not now.filter("_to IS NOT NULL").isEmpty():
        at = now.select(
            F.col("_v").alias("_w"), F.col("_to").alias("_next"), F.col("_d").alias("_more"),
            F.col("_end").alias("_last"),
        )
        ahead = now.filter("_to IS NOT NULL").join(at, F.col("_to") == F.col("_w"))
        ahead = ahead.select(
            "_v", F.col("_next").alias("_to"), (F.col("_d") + F.col("_more")).alias("_d"), F.col("_last").alias("_end")
        )
        now = store(now.filter("_to IS NULL").unionByName(ahead), "pointers")
    return now


def reply_order(tree: DataFrame) -> DataFrame:
    """``(_g, position)`` of rows ``(_g, _first, _p)``, the message answered being ``_p`` < ``_g``: each
    message stands before its answers, with all that follows from one answer before the next one.

    Only conversations that branch are ranked; in the others each message answers the one before it.
    """
    tree = store(tree, "replies")
    branches = tree.filter(F.col("_p") != F.col("_g") - 1).select("_first").distinct()
    straight = tree.join(branches, "_first", "left_anti").select("_g", (F.col("_g") - F.col("_first")).alias("position"))
    if branches.isEmpty():
        return straight
    tree = store(tree.join(branches, "_first", "left_semi"), "branched")
    answers = store(_numbered(tree.filter("_p IS NOT NULL").select("_p", "_g"), "_k", "_p", "_g"), "answers")
    # the next answer to the same message is the next row, also where one message has a third of all answers
    later = answers.select(F.col("_p").alias("_q"), (F.col("_k") - 1).alias("_k"), F.col("_g").alias("_sibling"))
    later = answers.join(later, "_k").filter("_p = _q").select("_g", "_sibling")
    child = answers.groupBy(F.col("_p").alias("_g")).agg(F.min("_g").alias("_child"))
    tree = store(tree.join(later, "_g", "left").join(child, "_g", "left"), "branched")
    none = F.lit(None).cast("bigint")
    # what follows all that a message led to: its sibling, or what follows the message answered
    up = tree.select(
        F.col("_g").alias("_v"), F.when(F.col("_sibling").isNull(), F.col("_p")).alias("_to"),
        F.lit(0).cast("bigint").alias("_d"), F.col("_sibling").alias("_end"),
    )
    after = _followed(up).select(F.col("_v").alias("_g"), F.col("_end").alias("_after"))
    follows = tree.join(after, "_g").select(F.coalesce("_child", "_after").alias("_v"), F.col("_g").alias("_to"))
    back = follows.filter("_v IS NOT NULL").select("_v", "_to", F.lit(1).cast("bigint").alias("_d"), none.alias("_end"))
    heads = tree.filter("_p IS NULL").select(F.col("_g").alias("_v"), none.alias("_to"), F.lit(0).cast("bigint").alias("_d"), none.alias("_end"))
    ranked = _followed(back.unionByName(heads))
    return straight.unionByName(ranked.select(F.col("_v").alias("_g"), F.col("_d").alias("position")))


def link(
    df: DataFrame, scope: str = "conv_id", order: str = "turn", text: str = "text"
) -> DataFrame:
    """All columns, the text without quotes, and: ``quotes`` (level, text and source of each passage),
    ``reply_to`` (order of the message answered), ``by_quote`` and ``position``.
    """
    kept = [c for c in df.columns if c not in ("quotes", "reply_to", "by_quote", "position")]
    # names of the input's columns cannot meet those used here
    inner = {c: f"c{i}" for i, c in enumerate(kept)}
    df = df.select(*[F.col(f"`{c}`").alias(i) for c, i in inner.items()])
    scope, order, text = inner[scope], inner[order], inner[text]
    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    carried = [c for c in df.columns if c != text]
    schema = ", ".join(
        [
            *[f"`{c}` {kind[c]}" for c in [*carried, text]],
            "_quotes array<struct<level:int,text:string>>, _own array<bigint>, "
            "_asked array<struct<passage:int,level:int,h:bigint,n:bigint>>",
        ]
    )
    parsed = df.select(*carried, text).mapInArrow(_parsed(text, carried), schema)
    rows = store(_ordered(parsed, scope, order, text), "conversations")

    asked = rows.filter(F.size("_asked") > 0).select(
        "_scope", F.col("_g").alias("_to"), F.inline("_asked")
    )
    wanted = asked.select(F.col("_scope").alias("_s"), F.col("h").alias("_h")).distinct()
    said = rows.select("_scope", "_g", F.col(order).alias("_at"), F.explode("_own").alias("h"))
    said = said.join(wanted, F.col("_scope").eqNullSafe(F.col("_s")) & (F.col("h") == F.col("_h")), "left_semi")
    first = said.groupBy(F.col("_scope").alias("_s"), F.col("h").alias("_h")).agg(
        F.min("_g").alias("_from"), F.min_by("_at", "_g").alias("_at")
    )
    met = asked.join(first, F.col("_scope").eqNullSafe(F.col("_s")) & (F.col("h") == F.col("_h")))
    met = met.filter(F.col("_from") < F.col("_to"))
    shared = met.groupBy("_to", "passage", "level", "_from", "_at").agg(F.sum("n").alias("n"))
    shared = store(shared, "quote-links")
    best = F.max_by(F.struct("_at"), F.struct("n", "_from")).alias("b")
    passages = shared.groupBy("_to", "passage").agg(best)
    passages = passages.groupBy("_to").agg(
        F.map_from_entries(F.collect_list(F.struct("passage", F.col("b._at").alias("at")))).alias("_sources")
    )
    answered = shared.filter("level = 1").groupBy("_to", "_from", "_at").agg(F.sum("n").alias("n"))
    answer = F.max_by(F.struct("_at", "_from"), F.struct("n", "_from")).alias("_answer")
    answered = store(answered.groupBy(F.col("_to").alias("_t")).agg(answer), "answered")

    parent = F.when(F.col("_g") > F.col("_first"), F.coalesce("_answer._from", F.col("_g") - 1))
    replies = rows.join(answered, F.col("_g") == F.col("_t"), "left").select("_g", "_first", parent.alias("_p"))
    places = reply_order(replies).select(F.col("_g").alias("_place"), "position")

    before = rows.select(
        F.col("_first").alias("_f"), (F.col("_g") + 1).alias("_next"), F.struct(F.col(order).alias("_at")).alias("_before")
    )
    out = rows.join(before, (F.col("_g") == F.col("_next")) & (F.col("_first") == F.col("_f")), "left")
    out = out.join(places, F.col("_g") == F.col("_place"))
    out = out.join(passages, F.col("_g") == F.col("_to"), "left")
    out = out.join(answered, F.col("_g") == F.col("_t"), "left")
    quotes = F.transform(
        "_quotes",
        lambda q, i: F.struct(
            q["level"].alias("level"), q["text"].alias("text"),
            F.try_element_at("_sources", i).alias("source"),
        ),
    )
    return out.select(
        *[F.col(i).alias(c) for c, i in inner.items()],
        quotes.alias("quotes"),
        F.coalesce("_answer._at", "_before._at").alias("reply_to"),
        F.col("_answer").isNotNull().alias("by_quote"),
        "position",
    )


@query("op1_quotation_linking")
def op1_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = link(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    linked = F.filter("quotes", lambda q: q["source"].isNotNull())
    return out.select(
        "conv_id", "turn", "role", "text", "reply_to", "by_quote", "position",
        F.size("quotes").alias("n_quotes"), F.size(linked).alias("n_linked"),
    )
