"""N-gram Jaccard self-join with several global token orders.

Tokens are hashes of five-word shingles. Under any global order of tokens, two
sets that are similar enough share tokens in their prefixes, and as many of them
as their sizes demand. Three orders are used: one puts rare tokens first, the
other two are independent hashes of the token. An inverted index of the prefixes
under the first order gives pairs, as its posting lists are short; a shared token
must lie early enough in both sets for their sizes. The prefixes of each pair under
the second order and then under the third must share enough tokens too. Only what
passes all three orders is verified, with whole texts. Frequencies for the first
order come from a sketch of fixed size over all documents; any order is a correct
one, so its errors cost time, never results.

Equal sets are one set from the start. Among different sets, the members of
a posting list are first compared with a few pivots, of which each set takes one in
the first round and one under each order in the second; sets that turn out connected
need no further comparison with each other. Pivots are the documents whose prefixes
are shared most, as those of the original of many altered copies. At the end every
pair of a posting list that is still in different components is compared. So a
large group of near copies costs about as many comparisons as it has members, and
no link between components is missed. The rounds are the same at every size.

Defined cases: null texts and texts without words are empty sets, linked with
nothing; shorter texts are one shingle; rows with equal doc_id are one node with
several sets; rows with a null doc_id link with nothing; ties between pivots go
to the smaller doc_id; an empty table gives an empty one; other columns are not
read, and ``drop_similar`` keeps them. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Powers, Scratch, arrow_batch, components, fresh_name, map_arrow, mix, pack_text, packed, unpack, unpack_text, utf8, word_hashes

#: log2 of the counters of the frequency sketch: 2 MB of memory, at any size of input.
SKETCH_BITS = 18
#: Pivots of a token in the second round.
PIVOTS = 4
#: Sets that a task remembers to have posted; forgetting costs repeated postings only.
POSTED = 100_000
#: Partners of one pivot that a single group of the verification holds.
GROUP = 1000


def shingles(text: bytes, powers: Powers, n: int = 5) -> np.ndarray:
    """The sorted set of hashed shingles of a text."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    if len(words) < n:
        return mix(powers.windows(h, len(words)), len(words))
    s = np.sort(powers.windows(h, n))
    return s[np.concatenate([[True], s[1:] != s[:-1]])]


def prefix_length(n: int, percent: int) -> int:
    """How many first tokens of a set of ``n`` meet those of every similar set."""
    return n - -(-n * percent // 100) + 1


def _sets(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """Sketch counters (bucket, count) and one row (doc_id, n, hi, lo) per document, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        schema = pa.schema([("bucket", pa.int32()), ("count", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32()), ("hi", pa.int64()), ("lo", pa.int64())])
        count = np.zeros(1 << SKETCH_BITS, np.int64)
        for b in batches:
            rows, some = [], []
            for d, t in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True):
                s = shingles(t or b"", powers, n)
                hi, lo = int(mix(s, 1).sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(mix(s, 2)))
                rows.append((d, len(s), hi - (1 << 63), lo - (1 << 63)))
                some.append(s)
            if some:
                count += np.bincount((np.concatenate(some) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(count))
                yield arrow_batch(schema, [None] * len(rows), [None] * len(rows), *map(list, zip(*rows)))
        at = np.flatnonzero(count)
        none = [None] * len(at)
        yield arrow_batch(schema, at, count[at], none, none, none, none)

    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_arrow(slim, run, "bucket int, count long, doc_id long, n int, hi long, lo long")


def prefix(s: np.ndarray, frequency: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The prefix of a set under one of the orders: 0 puts rare tokens first, others are hashes."""
    if not len(s):
        return s
    keys = (s, frequency[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]) if order == 0 else (mix(s, 10 + order),)
    return s[np.lexsort(keys)[: prefix_length(len(s), percent)]]


def hashed_prefix(s: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The prefix of a set under a hash order, as sorted 32-bit values; equal ones by chance only weaken a filter."""
    k = prefix_length(len(s), percent)
    h = mix(s, 10 + order)
    return np.sort((h if k >= len(h) else np.partition(h, k - 1)[:k]) >> np.uint64(32)).astype(np.uint32)


def _postings(docs: DataFrame, frequency, key: str, text: str, percent: int, n: int) -> DataFrame:
    """(token, mark, doc_id, n, at): the inverted index of prefixes under the first order.

    ``mark`` is a hash of the whole set and ``at`` the token's place in the prefix.
    Only the smallest doc_id of equal sets matters, so a task leaves out a set that
    it has already posted for a smaller one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, posted = Powers(), {}
        schema = pa.schema([("token", pa.int64()), ("mark", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32()), ("at", pa.int32())])
        for b in batches:
            tokens, marks, ids, sizes = [], [], [], []
            for d, t in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True):
                s = shingles(t or b"", powers, n)
                mark = int(mix(s, 1).sum(dtype=np.uint64))
                if not len(s) or posted.get(mark, d + 1) <= d:
                    continue
                if len(posted) >= POSTED:
                    posted.clear()
                posted[mark] = d
                tokens.append(prefix(s, frequency.value, 0, percent))
                marks.append(mark)
                ids.append(d)
                sizes.append(len(s))
            k = [len(x) for x in tokens]
            if k:
                each = (np.repeat(np.array(c, kind), k) for c, kind in ((marks, np.uint64), (ids, np.int64), (sizes, np.int32)))
                mark, doc, size = each
                yield arrow_batch(schema, np.concatenate(tokens).view(np.int64), mark.view(np.int64), doc, size, np.concatenate([np.arange(1, x + 1, dtype=np.int32) for x in k]))

    slim = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_arrow(slim, run, "token long, mark long, doc_id long, n int, at int")


def _shared(postings: DataFrame) -> DataFrame:
    """(token, doc_id, n, at, p, pn, pat): postings of tokens that different sets share, one of each set.

    A scan in order of (token, mark, doc_id) keeps the smallest doc_id of equal
    sets; the first posting of a token, ``p``, is the pivot of the first round.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("token", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32()), ("at", pa.int32()), ("p", pa.int64()), ("pn", pa.int32()), ("pat", pa.int32())])
        before = None  # (token, mark) of the last row
        waiting = None  # the only posting so far of the last token
        pivot = None  # the first posting of the last token, if that has been written
        for b in batches:
            if not b.num_rows:
                continue
            t, m = b.column(0).to_numpy(), b.column(1).to_numpy()
            new = np.concatenate([[before != (t[0], m[0])], (t[1:] != t[:-1]) | (m[1:] != m[:-1])])
            before = (t[-1], m[-1])
            rows = np.stack([t, *(b.column(i).to_numpy().astype(np.int64) for i in (2, 3, 4))])[:, new]
            if waiting is not None:
                rows = np.concatenate([waiting, rows], axis=1)
            if not rows.shape[1]:
                continue
            start = np.concatenate([[True], rows[0, 1:] != rows[0, :-1]])
            group, first = np.cumsum(start) - 1, np.flatnonzero(start)
            size = np.bincount(group)
            lead = rows[:, first]
            if pivot is not None and pivot[0] == rows[0, 0]:
                lead[:, 0] = pivot
                size[0] += 1
            hit = (size > 1)[group]
            if hit[-1]:
                waiting, pivot = None, lead[:, -1].copy()
            else:
                waiting, pivot = rows[:, -1:].copy(), None
            yield arrow_batch(schema, *rows[:, hit], *lead[1:, group[hit]])

    return map_arrow(postings.repartition("token").sortWithinPartitions("token", "mark", "doc_id"), run, "token long, doc_id long, n int, at int, p long, pn int, pat int")


def _profiles(texts: DataFrame, percent: int, n: int) -> DataFrame:
    """(doc_id, n, p1, p2, ztext): sizes, and prefixes under the second and third order as 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("p1", pa.binary()), ("p2", pa.binary()), ("ztext", pa.binary())])
        for b in batches:
            z = b.column(1).to_pylist()
            sets = [shingles(unpack(x), powers, n) for x in z]
            p1, p2 = ([hashed_prefix(s, k, percent).tobytes() if len(s) else b"" for s in sets] for k in (1, 2))
            yield arrow_batch(schema, b.column(0).to_numpy(), [len(s) for s in sets], p1, p2, z)

    return map_arrow(texts, run, "doc_id long, n int, p1 binary, p2 binary, ztext binary")


def _sharing(pairs: DataFrame, profiles: DataFrame, order: int, percent: int) -> DataFrame:
    """Pairs (u, v) whose prefixes under a hash order share as many tokens as those of similar sets of their sizes."""
    side = lambda k: profiles.select(F.col("doc_id").alias(k), F.col("n").alias(f"n{k}"), F.col(f"p{order}").alias(f"p{k}"))
    both = pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", "nu", "nv", "pu", "pv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
        for b in batches:
            u, v, nu, nv = (b.column(i).to_numpy().astype(np.int64) for i in range(4))
            common = -(-percent * (nu + nv) // (100 + percent))
            # Common tokens outside the prefix of a set of m number ceil(percent m / 100) - 1 at most.
            need = common + 1 + (-percent * np.maximum(nu, nv) // 100)
            keep = np.zeros(len(u), bool)
            for i, (x, y) in enumerate(zip(b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True)):
                h = np.sort(np.concatenate([np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)]))
                keep[i] = np.count_nonzero(h[1:] == h[:-1]) >= need[i]
            yield arrow_batch(schema, u[keep], v[keep])

    return map_arrow(both, run, "u long, v long")


def _verified(pairs: DataFrame, profiles: DataFrame, percent: int, n: int) -> DataFrame:
    """(u, v): the pairs (u, v) whose sets are similar enough. ``pairs`` is a table."""
    groups = pairs.groupBy("u").agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    salted = pairs.join(groups, "u").select("u", "v", F.pmod(F.xxhash64("v"), F.col("groups")).alias("salt"))
    left = salted.select("u", "salt").distinct().select("u", "salt", F.col("u").alias("doc_id"), F.lit(0).alias("side"))
    both = left.unionByName(salted.select("u", "salt", F.col("v").alias("doc_id"), F.lit(1).alias("side"))).join(profiles.select("doc_id", "ztext"), "doc_id")
    both = both.select("u", "salt", "side", "doc_id", "ztext").repartition("u", "salt").sortWithinPartitions("u", "salt", "side")

    def meet(a: np.ndarray, b: np.ndarray) -> bool:
        if percent * max(len(a), len(b)) > 100 * min(len(a), len(b)):
            return False
        x = np.sort(np.concatenate([a, b]))
        common = int((x[1:] == x[:-1]).sum())
        return 100 * common >= percent * (len(a) + len(b) - common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, schema = Powers(), pa.schema([("u", pa.int64()), ("v", pa.int64())])
        group, pivots = None, []
        for b in batches:
            us, vs = [], []
            for u, salt, side, d, z in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if (u, salt) != group:
                    group, pivots = (u, salt), []
                s = shingles(unpack(z), powers, n)
                if side == 0:
                    pivots.append(s)
                elif len(s) and any(len(p) and meet(p, s) for p in pivots):
                    us.append(u)
                    vs.append(d)
            yield arrow_batch(schema, us, vs)

    return map_arrow(both, run, "u long, v long")


def _common(a: str, b: str, percent: int) -> str:
    """The least intersection of similar sets of two sizes."""
    return f"(({percent} * ({a} + {b}) + {99 + percent}) div {100 + percent})"


def _meets(a: str, b: str, at_a: str, at_b: str, percent: int):
    """Whether sets of two sizes can be similar, and a shared token is in both prefixes that these sizes need."""
    common = _common(a, b, percent)
    return F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b}) and {at_a} <= {a} - {common} + 1 and {at_b} <= {b} - {common} + 1")


def _spanning(postings: DataFrame, found: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(token, doc_id, n, at, share, component): the posting lists that span several components so far."""
    label = components(found, scratch)
    named = nodes.join(label, nodes["doc_id"] == label["node"], "left").select("doc_id", "share", F.coalesce("component", "doc_id").alias("component"))
    named = scratch.save(postings.select("token", "doc_id", "n", "at").join(named, "doc_id"))
    # Tables on both sides of a join, so that a hot token can be split.
    ends = scratch.save(named.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("token"))
    return scratch.save(named.join(ends, "token"))


def _pivot_pairs(spanning: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(u, v): members of posting lists and the pivots of their token that are in other components.

    Pivots come first under each of a few orders of the documents: by the share of their
    prefix that other sets have, as the original of many altered copies, then at random.
    """
    random = lambda i: F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(i)), 5)
    places = [F.shiftleft((15 - F.col("share")).cast("long"), 59).bitwiseOR(random(i)) for i in range(PIVOTS)]
    first = scratch.save(spanning.groupBy("token").agg(*[F.min(k).alias(f"k{i}") for i, k in enumerate(places)]))
    leads = F.lit(False)
    for i, k in enumerate(places):
        leads = leads | (k == F.col(f"k{i}"))
    pivots = spanning.join(first, "token").where(leads).select("token", F.col("doc_id").alias("p"), F.col("n").alias("pn"), F.col("at").alias("pat"), F.col("component").alias("pc"), *[k.alias(f"r{i}") for i, k in enumerate(places)])
    pairs = spanning.join(scratch.save(pivots), "token").where((F.col("component") != F.col("pc")) & _meets("n", "pn", "at", "pat", percent))
    # Of the pivots of all its tokens, a document meets the first under each order. Either end may be a pivot of the other.
    best = pairs.groupBy("doc_id").agg(*[F.min_by("p", f"r{i}").alias(f"p{i}") for i in range(PIVOTS)])
    best = best.select("doc_id", F.explode(F.array_distinct(F.array(*[f"p{i}" for i in range(PIVOTS)]))).alias("p"))
    return best.select(F.least("p", "doc_id").alias("u"), F.greatest("p", "doc_id").alias("v"))


def _first_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """(u, v): each document and, of the first postings of its tokens, the one it shares most tokens with."""
    meeting = shared.where((F.col("doc_id") != F.col("p")) & _meets("n", "pn", "at", "pat", percent)).groupBy("doc_id", "p").agg(F.count("*").alias("tokens"))
    best = meeting.groupBy("doc_id").agg(F.max_by("p", F.struct("tokens", -F.col("p"))).alias("p"))
    return best.select(F.least("p", "doc_id").alias("u"), F.greatest("p", "doc_id").alias("v"))


def _pairs_between(spanning: DataFrame, percent: int) -> DataFrame:
    """(u, v): all pairs of a posting list that are in different components; pairs in one are never formed.

    Components whose sizes and places leave no candidate are not joined.
    """
    parts = spanning.groupBy("token", "component").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.min("at").alias("at"))
    one, two = (parts.select("token", F.col("component").alias(f"c{i}"), F.col("least").alias(f"least{i}"), F.col("most").alias(f"most{i}"), F.col("at").alias(f"at{i}")) for i in (1, 2))
    near = F.expr(
        f"c1 < c2 and 100 * most1 >= {percent} * least2 and 100 * most2 >= {percent} * least1"
        f" and at1 <= most1 - {_common('most1', 'least2', percent)} + 1 and at2 <= most2 - {_common('most2', 'least1', percent)} + 1"
    )
    between = one.join(two, "token").where(near).select("token", F.col("c1").alias("component"), F.col("c2").alias("other"))
    left = between.join(spanning.select("token", "component", F.col("doc_id").alias("u"), F.col("n").alias("nu"), F.col("at").alias("au")), ["token", "component"])
    right = spanning.select("token", F.col("component").alias("other"), F.col("doc_id").alias("v"), F.col("n").alias("nv"), F.col("at").alias("av"))
    pairs = left.join(right, ["token", "other"]).where(_meets("nu", "nv", "au", "av", percent))
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))


def similar_sets(docs: DataFrame, scratch: Scratch, percent: int = 80, n: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of ``docs``."""
    with scratch.temporary() as own:
        return scratch.save(_similar_sets(docs, own, percent, n, key, text))


def _similar_sets(docs: DataFrame, scratch: Scratch, percent: int, n: int, key: str, text: str) -> DataFrame:
    read = scratch.save(_sets(docs, key, text, n))
    # The sketch: 2**SKETCH_BITS counters at most, whatever the input.
    sketch = read.where("bucket is not null").groupBy("bucket").agg(F.sum("count").alias("count")).toArrow()
    count = np.zeros(1 << SKETCH_BITS, np.int64)
    count[np.asarray(sketch["bucket"])] = np.asarray(sketch["count"])
    frequency = docs.sparkSession.sparkContext.broadcast(count)

    # Equal sets have one representative, the smallest doc_id. Both sides of the join are tables, so that a hot set can be split.
    sets = read.where("bucket is null").select("doc_id", "n", "hi", "lo")
    usable = sets.where("doc_id is not null and n > 0")
    firsts = scratch.save(usable.groupBy("n", "hi", "lo").agg(F.min("doc_id").alias("first")))
    twins = scratch.save(usable.join(firsts, ["n", "hi", "lo"]).where("doc_id <> first").select(F.col("first").alias("u"), F.col("doc_id").alias("v")))

    live = scratch.save(_shared(_postings(docs, frequency, key, text, percent, n)))
    nodes = live.groupBy("doc_id").agg(F.floor(10 * F.count("*") / F.first(F.expr(f"n - (({percent} * n + 99) div 100) + 1"))).alias("share"))
    nodes = scratch.save(nodes)
    # By a sort-merge join, whose tasks each hold whole buckets; a broadcast would leave every task writing to all buckets.
    texts = packed(docs.where(F.col(key).isNotNull()), key, text).withColumnRenamed(key, "doc_id").join(nodes.hint("merge"), "doc_id", "left_semi")
    profiles = scratch.save_by(_profiles(texts, percent, n), "doc_id")

    def similar(pairs: DataFrame) -> DataFrame:
        pairs = scratch.save(pairs.distinct())
        for order in (1, 2):
            pairs = scratch.save(_sharing(pairs, profiles, order, percent))
        return scratch.save(_verified(pairs, profiles, percent, n))

    # Every document and the first posting it is nearest to; then the best pivots; then all that is left between components.
    found = similar(_first_pairs(live, percent))
    spanning = _spanning(live, found, nodes, scratch)
    found = found.unionByName(similar(_pivot_pairs(spanning, percent, scratch)))
    found = found.unionByName(similar(_pairs_between(_spanning(spanning, found, nodes, scratch), percent)))
    label = components(twins.unionByName(found), scratch)
    return sets.join(label, sets["doc_id"] == label["node"], "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def drop_similar(docs: DataFrame, scratch: Scratch, percent: int = 80, n: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest key.

    Documents and the ids that go meet by a merge join at every size, as there is no bound on those ids; texts are compressed meanwhile. Rows with a null key stay; of rows with equal key all stay or go together.
    """
    gone = fresh_name("__gone", docs)
    similar = similar_sets(docs, scratch, percent, n, key, text).where("doc_id <> component_id").select(F.col("doc_id").alias(gone)).distinct()
    column = F.col(f"`{text}`")
    slim = docs.withColumn(text, pack_text(column.cast("string")))
    return slim.join(similar.hint("merge"), F.col(f"`{key}`").cast("long") == F.col(gone), "left_anti").withColumn(text, unpack_text(column).cast(docs.schema[text].dataType))
