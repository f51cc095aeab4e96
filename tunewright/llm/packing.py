"""Tokenise documents and pack them into training sequences: shortest pack first.

Packing needs only the histogram of lengths, which has at most ``size`` entries whatever the corpus.
A document is cut into full sequences and one rest. Lengths are placed longest first; all documents
of a length are placed at once, into the open packing pattern with most documents that has room for
them, shortest pack (most room) first, and what does not fit opens new packs. The patterns are then
joined back to the documents by rank: the r-th document of a length takes the r-th place that the
patterns have for that length. Ranks come from the tasks' own counts and offsets, so a length that
many documents share is never sorted or gathered in one task.

Words between ASCII white space are tokenised once per worker and remembered up to a fixed number
(the tokenizer drops white space, so it never joins two words); token ids of a document are then
gathered from the remembered words by NumPy.

Defined results: null and empty texts have one token, the end of the text; repeated rows are packed
each by itself; an empty table gives an empty result. Columns of the input that are called like an
output column are replaced.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunewright.llm import words as W
from tunewright.llm.registry import query
from tunewright.session import store

KNOWN_WORDS = 1_500_000
OFFSET_ROWS = 200_000


class WordTokens:
    """Token ids of byte words, remembered by the words' hashes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.hash = np.zeros(0, np.uint64)
        self.at = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and all ids: many words are encoded as one text."""
        counts, ids = [], []
        for i in range(0, len(found), 256):
            part = found[i : i + 256]
            e = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            stops = np.cumsum([len(w) + 1 for w in part])
            begins = np.fromiter((o[0] for o in e.offsets), np.int64, len(e.ids))
            counts.append(
                np.bincount(np.searchsorted(stops, begins, "right"), minlength=len(part))
            )
            ids.append(np.array(e.ids, np.uint32))
        return np.concatenate(counts), np.concatenate(ids)

    def learn(self, hashes: np.ndarray, found: list[str]) -> None:
        """Remember words that are new; ``hashes`` is sorted."""
        n, ids = self._encode(found)
        where = np.searchsorted(self.hash, hashes)
        size = np.insert(np.diff(self.at), where, n)
        into = np.repeat(self.at[where], n)
        self.ids = np.insert(self.ids, into, ids)
        self.hash = np.insert(self.hash, where, hashes)
        self.at = np.concatenate([[0], np.cumsum(size)])

    def of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts, and where each text begins (with the end of the last)."""
        data, offsets = W.texts(column)
        starts, ends, first = W.spans(data, offsets)
        h = W.hashes(data, starts, ends)
        order = np.argsort(h, kind="stable")
        lead = np.ones(len(h), bool)
        lead[1:] = h[order][1:] != h[order][:-1]
        one = order[lead]
        unique = h[one]
        number = np.empty(len(h), np.int64)
        number[order] = np.cumsum(lead) - 1
        if len(self.hash) + len(unique) > KNOWN_WORDS:
            self._forget()
        at = np.searchsorted(self.hash, unique)
        known = np.zeros(len(unique), bool)
        if len(self.hash):
            known = self.hash[np.minimum(at, len(self.hash) - 1)] == unique
        new = one[~known]
        if len(new):
            raw = data.tobytes()
            found = [raw[a:b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]
            self.learn(unique[~known], found)
            at = np.searchsorted(self.hash, unique)
        place = at[number]
        n = self.at[place + 1] - self.at[place]
        total = np.concatenate([[0], np.cumsum(n)])
        pick = np.arange(total[-1]) + np.repeat(self.at[place] - total[:-1], n)
        return self.ids[pick], total[first]


Parts = tuple[tuple[int, int], ...]


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[Parts, int]]:
    """Packing patterns, as (length, times) parts, and how many packs have each.

    A pack that is opened takes as many documents of the length as it can hold. Placing goes on in
    the pack with most room until another has more.
    """
    shortest = min(histogram, default=1)
    open_packs: list[tuple[int, int, Parts, int]] = []
    done: list[tuple[Parts, int]] = []
    made = 0

    def put(room: int, parts: Parts, packs: int) -> None:
        nonlocal made
        if room < shortest:
            done.append((parts, packs))
            return
        made += 1
        heapq.heappush(open_packs, (-room, made, parts, packs))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and open_packs and -open_packs[0][0] >= length:
            room, _, parts, packs = heapq.heappop(open_packs)
            room = -room
            below = -open_packs[0][0] if open_packs else 0
            times = room // length if length <= 16 else min(room // length, (room - below) // length + 1)
            times = min(times, left)
            used = min(packs, left // times)
            if used < packs:
                put(room, parts, packs - used)
            put(room - times * length, (*parts, (length, times)), used)
            left -= used * times
        times = size // length
        packs, rest = divmod(left, times)
        for times, packs in ((times, packs), (rest, 1)):
            if times and packs:
                put(size - times * length, ((length, times),), packs)
    return done + [(parts, packs) for _, _, parts, packs in open_packs]


class Places:
    """The places that the patterns have for each length, in the order of their ranks."""

    def __init__(self, patterns: list[tuple[Parts, int]]):
        rows, first = [], 0
        for parts, packs in patterns:
            offset = 0
            for length, times in parts:
                rows.append((length, packs * times, times, first, offset))
                offset += length * times
            first += packs
        rows.sort(key=lambda r: r[0])
        t = np.array(rows, np.int64).reshape(-1, 5)
        self.length, n, self.times, self.first, self.offset = (c.copy() for c in t.T)
        edge = np.searchsorted(self.length, self.length)
        total = np.cumsum(n) - n
        self.begin = total - total[edge] if len(edge) else total
        # lengths and ranks as one ascending number
        self.step = int((self.begin + n).max(initial=0)) + 1
        self.key = self.length * self.step + self.begin

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the rank-th piece of each length."""
        i = np.searchsorted(self.key, length * self.step + rank, "right") - 1
        pack, inner = np.divmod(rank - self.begin[i], self.times[i])
        return self.first[i] + pack, self.offset[i] + inner * length


def _tokenise(path: str, text: str, carried: list[str], size: int, end: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        tokens = _tokens(path)
        seen = np.zeros(size + 1, np.int64)
        for b in W.pieces(batches, 4 << 20):
            ids, first = tokens.of(b.column(text))
            n = np.diff(first) + 1
            ids = np.insert(ids, first[1:], np.uint32(end)).astype("<u4", copy=False)
            begin = np.cumsum(n) - n
            cut = -(-n // size)
            doc = np.repeat(np.arange(len(n)), cut)
            start = size * (np.arange(len(doc)) - np.repeat(np.cumsum(cut) - cut, cut))
            length = np.minimum(size, n[doc] - start)
            order = np.argsort(length, kind="stable")
            counts = np.bincount(length, minlength=size + 1)
            lead = np.cumsum(counts) - counts
            nth = np.empty(len(length), np.int64)
            nth[order] = np.arange(len(length)) + np.repeat(seen - lead, counts)
            seen += counts
            at = begin[doc] + start
            raw = ids.data.cast("B")
            crc = [crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist(), strict=True)]
            columns = {
                **{c: b.column(c).take(pa.array(doc)) for c in carried},
                "start": pa.array(start),
                "length": pa.array(length),
                "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": pa.array(n[doc]),
            }
            if with_ids:
                stops = np.append(np.cumsum(length) - length, length.sum()).astype(np.int32)
                columns["ids"] = pa.ListArray.from_arrays(pa.array(stops), pa.array(ids.view(np.int32)))
            columns["_task"] = pa.array(np.full(len(doc), task, np.int32))
            columns["_nth"] = pa.array(nth)
            yield pa.RecordBatch.from_pydict(columns)

    return run


_TOKENS: dict[str, WordTokens] = {}


def _tokens(path: str) -> WordTokens:
    """One per worker and file, kept for its later tasks."""
    if path not in _TOKENS:
        _TOKENS[path] = WordTokens(path)
    return _TOKENS[path]


def _placed(shared, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: Places = shared.value
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            sequence, offset = places.find(length, rank)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in carried], pa.array(sequence), pa.array(offset)],
                names=[*carried, "sequence_id", "offset"],
            )

    return run


_OUT = ("start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset")


def pack(
    df: DataFrame,
    tokenizer: str,
    text: str = "text",
    size: int = 4096,
    end: int = 2,
    keep: list[str] | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """One row for each piece of a document: the columns ``keep`` (default: all but the text), where
    it lies in its document and its sequence, and its ``ids``. ``tokenizer`` is a file that every
    worker can read; ``end`` closes each document.
    """
    spark = df.sparkSession
    df = df.drop(*[c for c in _OUT if c != text])
    keep = [c for c in (keep or df.columns) if c in df.columns and (keep or c != text)]
    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    own = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    own += ", ids array<int>" if with_ids else ""
    head = [f"`{c}` {kind[c]}" for c in keep]
    schema = ", ".join([*head, own, "_task int, _nth bigint"])
    used = list(dict.fromkeys([*keep, text]))
    cut = _tokenise(tokenizer, text, keep, size, end, with_ids)
    pieces = store(df.select(used).mapInArrow(cut, schema), "pieces")

    sizes = store(pieces.groupBy("length", "_task").agg(F.count(F.lit(1)).alias("_rows")), "lengths")
    # one entry for each length up to ``size``
    lengths = sizes.groupBy("length").agg(F.sum("_rows").alias("n")).collect()
    patterns = shortest_pack_first({r["length"]: r["n"] for r in lengths}, size)
    shared = spark.sparkContext.broadcast(Places(patterns))

    earlier = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("_rows").over(earlier) - F.col("_rows")
    offsets = sizes.select("length", "_task", before.alias("_before"))
    if sizes.count() <= OFFSET_ROWS:
        offsets = F.broadcast(offsets)
    ranked = pieces.join(offsets, ["length", "_task"])
    named = [c for c in pieces.columns if c not in ("_task", "_nth")]
    ranked = ranked.select(*named, (F.col("_nth") + F.col("_before")).alias("_rank"))
    out = ", ".join([*head, own, "sequence_id bigint, offset bigint"])
    return ranked.mapInArrow(_placed(shared, named), out)


def padding(packed: DataFrame, size: int = 4096) -> DataFrame:
    """Sequences, tokens and padding; a sequence at a power of two is not padded."""
    s = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    power = F.col("n").bitwiseAND(F.col("n") - 1) == 0
    return s.agg(
        F.count(F.lit(1)).alias("sequences"),
        F.sum("n").alias("tokens"),
        F.sum(F.when(power, 0).otherwise(size - F.col("n"))).alias("padding"),
    )


@query("op6_shortest_pack_first")
def op6_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack(docs, str(path), keep=["doc_id"], with_ids=False)
