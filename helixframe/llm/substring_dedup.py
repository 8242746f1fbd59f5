"""Substring dedup by seed and extend.

Seeds: every run of ``window`` words holds ``window - SEED + 1`` word k-grams;
its anchor is the one with the least hash (winnowing), so equal runs have equal
anchors in equal places. Documents are joined on anchors that occur twice.
Match: around an occurrence of such an anchor are up to 15 places where ``window``
words can begin; each of these is one hash, and the place is matched with the first
place, by doc_id and word, whose words are equal. So every occurrence meets at most 15
others, never all of its anchor, as a common anchor would then need all its pairs, or
all of it in one task. Extend: matches of one document with the same other document at
the same distance lie on one diagonal; along it a match grows to the left and to the
right as long as the next one overlaps or touches it. What results is a repeat: words
``start`` to ``end`` equal those from ``from_start`` of ``from_doc``, which come
earlier. Repeats that overlap or touch make a maximal repeat; its words go.

Two shuffles carry seeds and extensions, both cut down within each task first: a task
keeps the first of equal seeds or extensions of its own documents and settles the rest
on the spot. Extensions are dealt by their own hash, not by their anchor, so a common
anchor with many different words around it spreads over all tasks, and no key has
more rows than tasks have read parts. A task holds one batch and one run. Texts are
compressed before they are shuffled, and meet anchors and repeats by merge joins at every
size, as neither has a bound; so work and disk on small tables tell those on large ones.

Defined cases: a null text has no words; texts under ``window`` words keep all;
rows with equal doc_id count as one document in which equal places do not repeat
each other; rows with a null doc_id keep all; ties cannot occur otherwise, as
(doc_id, place) is a total order; an empty table gives an empty one; columns of any
name are kept by ``drop_repeats``. Sequences are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Powers, Scratch, arrow_batch, fresh_name, map_arrow, pack_text, packed, unpack, utf8, word_hashes

SEED = 6
#: Runs or seeds that a task sorts together, in numbers.
TOGETHER = 2_000_000


def anchors(h: np.ndarray, window: int, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-grams, and for each run of ``window`` words the place of its anchor."""
    grams = powers.windows(h, SEED)
    width = window - SEED + 1
    at = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1)
    return grams, at + np.arange(len(at))


def _firsts(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The order by all columns, and which rows begin a group of the first column."""
    order = np.lexsort(columns[::-1])
    key = columns[0][order]
    return order, np.concatenate([[True], key[1:] != key[:-1]])


def _seeds(docs: DataFrame, window: int, key: str, text: str) -> DataFrame:
    """(anchor, doc_id, known): known seeds occur twice in what one task read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, schema = Powers(), pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64()), ("known", pa.bool_())])
        held: list[tuple[np.ndarray, int]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            seed = np.concatenate([x for x, _ in held])
            doc = np.repeat(np.array([d for _, d in held], np.int64), [len(x) for x, _ in held])
            order, first = _firsts([seed, doc])
            seed, doc = seed[order], doc[order]
            alone = first & np.concatenate([first[1:], [True]])
            # A row for other tasks for each distinct seed; seeds met twice here are settled, once for each document.
            once = ~alone & np.concatenate([[True], (seed[1:] != seed[:-1]) | (doc[1:] != doc[:-1])])
            twin = first & ~alone
            return arrow_batch(
                schema,
                np.concatenate([seed[alone], seed[twin], seed[once]]).view(np.int64),
                np.concatenate([doc[alone], doc[twin], doc[once]]),
                np.concatenate([np.zeros(alone.sum() + twin.sum(), bool), np.ones(once.sum(), bool)]),
            )

        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True):
                words = (t or b"").split()
                if d is None or len(words) < window:
                    continue
                grams, at = anchors(word_hashes(words), window, powers)
                held.append((grams[at[np.concatenate([[True], at[1:] != at[:-1]])]], d))
                size += len(held[-1][0])
                if size >= TOGETHER:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return map_arrow(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), run, "anchor long, doc_id long, known boolean")


def _met_twice(seeds: DataFrame) -> DataFrame:
    """(doc_id, anchor) of seeds that several tasks report, by a scan in order of anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("anchor", pa.int64())])
        last: tuple[int, int, bool] | None = None  # anchor, doc_id, whether it was written
        for b in batches:
            if not b.num_rows:
                continue
            a, d = b.column(0).to_numpy(), b.column(1).to_numpy()
            same = np.concatenate([[last is not None and last[0] == a[0]], a[1:] == a[:-1]])
            hit = same | np.concatenate([same[1:], [False]])
            if same[0] and not last[2]:
                yield arrow_batch(schema, [last[1]], [last[0]])
            yield arrow_batch(schema, d[hit], a[hit])
            last = (int(a[-1]), int(d[-1]), bool(hit[-1]))

    return map_arrow(seeds.repartition("anchor").sortWithinPartitions("anchor").select("anchor", "doc_id"), run, "doc_id long, anchor long")


def _runs(joined: DataFrame, window: int) -> DataFrame:
    """Runs around live seeds: (doc_id, start, bits, runs, from_doc, from_start).

    Rows without ``from_doc`` hold in ``runs`` the hashes of those runs from ``start`` whose
    bit is set. In the others, each such run equals one on the same diagonal of ``from_doc``,
    that of ``start`` being ``from_start``; the task met these before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        schema = pa.schema([
            ("doc_id", pa.int64()), ("start", pa.int32()), ("bits", pa.int32()), ("runs", pa.list_(pa.int64())), ("from_doc", pa.int64()), ("from_start", pa.int32()),
        ])
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            whole, start, begin = (np.concatenate([x[i] for x in held]) for i in range(3))
            doc = np.repeat(np.array([x[3] for x in held], np.int64), [len(x[0]) for x in held])
            order, first = _firsts([whole, doc, start])
            # Equal places of equal ids do not repeat each other.
            o_doc, o_start = doc[order], start[order]
            lead = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
            first |= (o_doc == o_doc[lead]) & (o_start == o_start[lead])
            keep, from_doc, from_start = np.zeros(len(whole), bool), np.zeros_like(doc), np.zeros_like(start)
            keep[order], from_doc[order], from_start[order] = first, o_doc[lead], o_start[lead]
            # Rows of one seed in one document stand together, in order of start.
            new = np.concatenate([[True], (begin[1:] != begin[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)])
            group = np.cumsum(new) - 1
            bit = np.int64(1) << (start - start[new][group])
            n = int(group[-1]) + 1
            todo = np.bincount(group, np.where(keep, bit, 0), n).astype(np.int32)
            kept = np.bincount(group, keep, n).astype(np.int32)
            # What is met here is one row for each stretch of a diagonal.
            turn = new | np.concatenate([[True], (keep[1:] != keep[:-1]) | (from_doc[1:] != from_doc[:-1]) | (from_start[1:] != from_start[:-1] + 1)])
            met = turn & ~keep
            ends = np.append(np.flatnonzero(turn)[1:], len(turn))[~keep[turn]]
            some = todo != 0
            m = int(met.sum())
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(kept[some]), np.full(m, kept.sum())]).astype(np.int32)), pa.array(whole[keep].view(np.int64))
            )
            blank = np.arange(some.sum() + m) < some.sum()
            none = np.zeros(some.sum(), np.int64)
            join = lambda a, b, kind: np.concatenate([a, b]).astype(kind)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(join(doc[new][some], doc[met], np.int64)),
                    pa.array(join(start[new][some], start[met], np.int32)),
                    pa.array(join(todo[some], (np.int64(1) << (ends - np.flatnonzero(met))) - 1, np.int32)),
                    lists,
                    pa.array(join(none, from_doc[met], np.int64), mask=blank),
                    pa.array(join(none, from_start[met], np.int32), mask=blank),
                ],
                schema=schema,
            )

        for b in batches:
            for d, t, live in zip(b.column("doc_id").to_pylist(), b.column("ztext").to_pylist(), b.column("anchors"), strict=True):
                words = unpack(t).split()
                if len(words) < window:
                    continue
                h = word_hashes(words)
                grams, at = anchors(h, window, powers)
                own = np.isin(grams[at].view(np.int64), np.asarray(live.values))
                s = np.flatnonzero(own)
                if len(s):
                    held.append((powers.windows(h, window)[s], s, at[s], d))
                    size += len(s)
                if size >= TOGETHER:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return map_arrow(joined, run, "doc_id long, start int, bits int, runs array<long>, from_doc long, from_start int")


def _dealt(runs: DataFrame) -> DataFrame:
    """(run, doc_id, place): a row for each run that is not settled, dealt by the run and in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("run", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int32())])
        for b in batches:
            row, bit = np.nonzero(b.column(2).to_numpy()[:, None] >> np.arange(31) & 1)
            yield arrow_batch(schema, b.column(3).flatten(), b.column(0).to_numpy()[row], (b.column(1).to_numpy()[row] + bit).astype(np.int32))

    flat = map_arrow(runs.where("from_doc is null").select("doc_id", "start", "bits", "runs"), run, "run long, doc_id long, place int")
    return flat.repartition("run").sortWithinPartitions("run", "doc_id", "place")


def _repeated(runs: DataFrame) -> DataFrame:
    """(doc_id, start, bits, from_doc, from_start): runs matched with an earlier equal run anywhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("bits", pa.int32()), ("from_doc", pa.int64()), ("from_start", pa.int32())])
        last: tuple[int, int, int] | None = None  # the run at the end of the last batch, and where it is first
        for b in batches:
            if not b.num_rows:
                continue
            key, doc, place = (b.column(i).to_numpy() for i in range(3))
            new = np.concatenate([[last is None or last[0] != key[0]], key[1:] != key[:-1]])
            lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
            first_doc, first_place = doc[lead], place[lead]
            if not new[0]:
                first_doc, first_place = np.where(lead < 0, last[1], first_doc), np.where(lead < 0, last[2], first_place)
            # Equal places of equal ids do not repeat each other.
            hit = (doc != first_doc) | (place != first_place)
            yield arrow_batch(schema, doc[hit], place[hit], np.ones(hit.sum(), np.int32), first_doc[hit], first_place[hit].astype(np.int32))
            last = (int(key[-1]), int(first_doc[-1]), int(first_place[-1]))

    found = map_arrow(_dealt(runs), run, "doc_id long, start int, bits int, from_doc long, from_start int")
    return found.unionByName(runs.where("from_doc is not null").select(*found.columns))


def _extended(found: DataFrame, window: int) -> DataFrame:
    """(doc_id, repeats): the matches of each document, extended along their diagonals.

    ``repeats`` are (start, end, from_doc, from_start) in words. A place has one match, more only
    where several rows have its doc_id, and equal matches are one.
    """
    repeat = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("from_doc", pa.int64()), ("from_start", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("repeats", pa.list_(repeat))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            size = b.column(1).value_lengths().to_numpy()
            start, bits, other, at = (x.to_numpy().astype(np.int64) for x in b.column(1).flatten().flatten())
            # A match of several bits is one longer match: its runs overlap.
            end = start + np.ceil(np.log2(bits + 1)).astype(np.int64) - 1 + window
            row, far = np.repeat(np.arange(len(size)), size), at - start
            order = np.lexsort([start, far, other, row])
            row, start, end, other, far = (x[order] for x in (row, start, end, other, far))
            off = np.concatenate([[True], (row[1:] != row[:-1]) | (other[1:] != other[:-1]) | (far[1:] != far[:-1])])
            # Ends may fall along a line where a document stands twice, so the largest so far counts.
            line = np.cumsum(off)
            reach = np.maximum.accumulate(end + line * (1 << 32)) - line * (1 << 32)
            new = off | np.concatenate([[True], start[1:] > reach[:-1]])
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(new)) - 1
            parts = [start[begin].astype(np.int32), reach[last].astype(np.int32), other[begin], (start + far)[begin].astype(np.int32)]
            offsets = np.concatenate([[0], np.cumsum(np.bincount(row[begin], minlength=len(size)))]).astype(np.int32)
            values = pa.StructArray.from_arrays([pa.array(x) for x in parts], fields=list(repeat))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets), values)], schema=schema)

    grouped = found.groupBy("doc_id").agg(F.collect_set(F.struct("start", "bits", "from_doc", "from_start")).alias("matches"))
    return map_arrow(grouped, run, "doc_id long, repeats array<struct<start int, end int, from_doc long, from_start int>>")


def _by_document(docs: DataFrame, scratch: Scratch, window: int, key: str, text: str) -> DataFrame:
    """(doc_id, repeats): for each document that has some, its repeats by :func:`_extended`."""
    if not SEED < window <= SEED + 30:
        raise ValueError(f"window must be from {SEED + 1} to {SEED + 30} words")
    with scratch.temporary() as own:
        seeds = own.save(_seeds(docs, window, key, text))
        live = _met_twice(seeds.where("not known")).unionByName(seeds.where("known").select("doc_id", "anchor"))
        live = live.groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))  # no more than a document has
        runs = own.save(_runs(packed(docs.where(F.col(key).isNotNull()), key, text).withColumnRenamed(key, "doc_id").join(live.hint("merge"), "doc_id"), window))
        return scratch.save(_extended(_repeated(runs), window))


def repeats(docs: DataFrame, scratch: Scratch, window: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, end, from_doc, from_start): words ``start`` to ``end`` of doc_id equal those from ``from_start`` of ``from_doc``.

    The other place is earlier, by document and word. Repeats of one document may overlap, as its words may be
    matched with several places; together they hold every run of ``window`` words that starts earlier too.
    """
    return _by_document(docs, scratch, window, key, text).select("doc_id", F.inline("repeats"))


def maximal_spans(found: list[dict] | None, window: int, n: int | None = None) -> list[tuple[int, int]]:
    """The repeats of a document as maximal spans that neither overlap nor touch, cut at ``n`` words."""
    spans: list[tuple[int, int]] = []
    for start, end in sorted((r["start"], r["end"] if n is None else min(r["end"], n)) for r in found or ()):
        if end - start < window:  # of a longer text with the same id
            continue
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
    return spans


def maximal_repeats(docs: DataFrame, scratch: Scratch, window: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, end): maximal passages, in words, covered by repeats; these words go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
        for b in batches:
            rows = [(d, *s) for d, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for s in maximal_spans(found, window)]
            yield arrow_batch(schema, *([r[i] for r in rows] for i in range(3)))

    return map_arrow(_by_document(docs, scratch, window, key, text), run, "doc_id long, start int, end int")


def dedup_digests(docs: DataFrame, scratch: Scratch, window: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    found = _by_document(docs, scratch, window, key, text)
    joined = packed(docs, key, text).withColumnRenamed(key, "doc_id").join(found.hint("merge"), "doc_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
        for b in batches:
            n, gone, sha = [], [], []
            for t, found in zip(b.column("ztext").to_pylist(), b.column("repeats").to_pylist(), strict=True):
                words = unpack(t).split()
                n.append(len(words))
                kept, at = [], 0
                for start, end in maximal_spans(found, window, len(words)):
                    kept += words[at:start]
                    at = end
                kept += words[at:]
                gone.append(len(words) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield arrow_batch(schema, b.column("doc_id").to_pylist(), n, gone, sha)

    return map_arrow(joined, run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def drop_repeats(docs: DataFrame, scratch: Scratch, window: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the words of repeats removed from their texts.

    Texts without a repeat stay as they are. In others, a removed word goes with
    the white space before it; documents of which nothing stays keep an empty text.
    """
    names, i = docs.columns, docs.columns.index(text)
    own, spans = fresh_name("__key", docs), fresh_name("__repeats", docs)
    found = _by_document(docs, scratch, window, key, text).select(F.col("doc_id").alias(own), F.col("repeats").alias(spans))
    slim = docs.withColumn(text, pack_text(F.col(f"`{text}`")))
    joined = slim.join(found.hint("merge"), F.col(f"`{key}`").cast("long") == F.col(own), "left").select(*[F.col(f"`{c}`") for c in names], spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = re.compile(rb"[^\x20\x09-\x0D]+")
        for b in batches:
            cols = list(b.columns[:-1])
            texts = [None if z is None else unpack(z).decode() for z in cols[i].to_pylist()]
            for k, found in enumerate(b.column(len(names)).to_pylist()):
                if found and texts[k]:
                    raw = texts[k].encode()
                    ends = [0, *(x.end() for x in word.finditer(raw))]
                    out, at = [], 0
                    for start, end in maximal_spans(found, window, len(ends) - 1):
                        out.append(raw[at : ends[start]])
                        at = ends[end]
                    texts[k] = b"".join([*out, raw[at:]]).decode()
            cols[i] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return map_arrow(joined, run, docs.schema)
