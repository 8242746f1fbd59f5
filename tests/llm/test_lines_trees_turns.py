"""Line dedup, Merkle manifest and conversation repair against plain versions and SQL."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import duckdb
import pytest
from helixframe.llm import conversations, line_dedup, merkle, oracles, queries
from helixframe.llm.common import Scratch
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CONV = "conv_id long, turn long, role string, text string"
SF = "/root/testdata/sf0.001"
LOWER = {i: i + 32 for i in range(65, 91)}
SPACE = " \t\n\x0b\x0c\r"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def same(a, b):
    assert sorted(map(repr, a)) == sorted(map(repr, b))


# --- lines -------------------------------------------------------------------

LONG = "A line of exactly forty code points, ééé"
assert len(LONG) == 40


def plain_lines(docs, least=40, many=5):
    key = lambda x: x.strip(SPACE).translate(LOWER)
    held = {}
    for d, t, *_ in docs:
        for x in (t or "").split("\n"):
            if len(key(x)) >= least:
                held.setdefault(key(x), set()).add(d)
    order = lambda d: (d is not None, d or 0)
    out = []
    for d, t, *_ in docs:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(held.get(key(x), ())) < many or max(held[key(x)], key=order) == d]
        out.append((d, len(lines), len(lines) - len(stay), sha("\n".join(stay))))
    return out


def line_docs():
    rng = random.Random(4)
    pool = [f"{LONG} {i}" for i in range(12)] + [LONG, LONG[:-1], "short", "", "   ", " " + LONG[1:]]
    dress = lambda x: rng.choice(["", " ", "\t", "\r\x0b"]) + rng.choice([str, str.upper, str.lower])(x) + rng.choice(["", "  ", "\r"])
    docs = [(i, "\n".join(dress(rng.choice(pool)) for _ in range(rng.randrange(12))), "en", "s", 1) for i in rng.sample(range(-50, 500), 60)]
    docs += [(None, f"{LONG} 1\n{LONG}", None, None, None), (None, LONG, None, None, None), (7000, None, "en", "s", 1), (7001, "", "en", "s", 1), (7002, "\n\n", "en", "s", 1)]
    # Rows of one id are one document; a line of four documents stays.
    docs += [(8000, f"only here, but four times over, and long enough\n{LONG} 2\n{LONG} 2", "en", "s", 1)] * 4
    docs += [(9000 + i, "a line that four documents hold is not a common line", "en", "s", 1) for i in range(4)]
    return docs + [(9100, "\n".join(["x" * 50] * 20_000), "en", "s", 1), *((9200 + i, "x" * 50, "en", "s", 1) for i in range(5))]


@pytest.mark.parametrize("batches, fanout", [(1, 4), (4, 4), (9, 2), (5, 3)])
def test_lines_against_a_plain_version(spark, batches, fanout):
    docs = line_docs()
    df = spark.createDataFrame(docs, DOCS)
    got = line_dedup.line_digests(df, Scratch(spark), batches=batches, fanout=fanout)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    want = plain_lines(docs)
    assert sum(x[2] for x in want) > 100
    same([tuple(r) for r in got.collect()], want)
    kept = line_dedup.dedup_lines(df.select("*", F.lit(1).alias("drops"), F.lit(2).alias("id")), Scratch(spark), batches=batches, fanout=fanout)
    assert kept.columns == [*df.columns, "drops", "id"]
    same([(r["doc_id"], sha(r["text"] or "")) for r in kept.collect()], [(x[0], x[3]) for x in want])
    assert kept.where("text is null").count() == 1


def test_runs_tell_new_lines_and_are_levelled(spark):
    runs = line_dedup.LineRuns(Scratch(spark), fanout=2)
    rows = lambda *h: spark.createDataFrame([(x, x, d) for x, d in h], "h1 long, h2 long, doc_id long")
    sizes = []
    for b in (rows((1, 9), (2, 9)), rows((2, 8), (3, 8), (3, 7)), rows((1, 6), (4, 6)), rows((4, 5), (3, 5))):
        new = runs.add(b)
        sizes.append([len(level) for level in runs.levels])
        last = {r["h1"]: (r["docs"], r["keeper"]) for r in new.collect()} if runs.levels[0] else last
    assert sizes == [[1], [0, 1], [1, 1], [0, 0, 1]]
    assert {r["h1"]: (r["docs"], r["keeper"]) for r in runs.merged().collect()} == {1: (2, 9), 2: (2, 9), 3: (3, 8), 4: (2, 6)}
    assert last == {1: (1, None), 4: (1, 6)}
    # Work goes on where another object has left it.
    on = line_dedup.LineRuns(Scratch(spark), 2, runs.levels)
    assert {r["h1"]: r["keeper"] for r in on.add(rows((4, 1), (5, 1))).collect()} == {4: None, 5: 1}


def test_lines_of_an_empty_table(spark):
    none = spark.createDataFrame([], DOCS)
    assert line_dedup.line_digests(none, Scratch(spark)).count() == 0 and line_dedup.dedup_lines(none, Scratch(spark)).count() == 0


# --- trees -------------------------------------------------------------------


def plain_leaf(d):
    doc, text, lang, source, n = d
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def plain_levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def plain_way(levels, i):
    for level in levels[:-1]:
        run = level[i // 8 * 8 : i // 8 * 8 + 8]
        yield "".join(run[: i % 8]), "".join(run[i % 8 + 1 :])
        i //= 8


def plain_manifest(docs):
    by = {}
    for d in docs:
        by.setdefault(d[2], []).append(d)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for x in langs:
        by[x].sort(key=lambda d: (d[0] is not None, d[0] or 0, plain_leaf(d)))
    trees = {x: plain_levels([plain_leaf(d) for d in by[x]]) for x in langs}
    top = plain_levels([trees[x][-1][0] for x in langs])
    out = []
    for k, x in enumerate(langs):
        for i, d in enumerate(by[x]):
            way = [*plain_way(trees[x], i), *plain_way(top, k)]
            bad = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0
            at = plain_leaf((d[0], d[1] and d[1].translate(LOWER), *d[2:])) if bad else plain_leaf(d)
            for a, b in way:
                at = sha(a + at + b)
            out.append((d[0], plain_leaf(d), trees[x][-1][0], top[-1][0], sha("".join(a + b for a, b in way)), at, at == top[-1][0]))
    return out


def tree_docs(sizes):
    rng = random.Random(len(sizes))
    docs, i = [], 0
    for lang, n in sizes:
        for _ in range(n):
            i += 1
            docs.append((rng.choice([i * 7, i * 7, -i]), rng.choice(["lower", "Upper Ä", "", None, "É only"]), lang, rng.choice(["s", None, "Ünï"]), rng.choice([5, None])))
    return docs


def tampered():
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 0


@pytest.mark.parametrize("sizes", [
    [("en", 1)], [("en", 8), ("de", 1)], [("en", 9), ("de", 64), (None, 3), ("", 2)], [("en", 600), ("de", 65), (None, 1), ("zz", 7)], [(f"l{i}", 1) for i in range(70)], [("en", 513)], [(f"l{i}", i) for i in range(1, 12)],
])
def test_manifest_against_a_plain_version(spark, sizes):
    docs = tree_docs(sizes)
    docs += docs[:3] + [(None, "A null id", sizes[0][0], None, 3)] * 2 if len(sizes) == 4 else []
    got = merkle.manifest_digests(spark.createDataFrame(docs, DOCS).withColumn("tree", F.lit(1)), Scratch(spark), tampered())
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = plain_manifest(docs)
    same([tuple(r) for r in got.collect()], want)
    con = duckdb.connect()
    con.register("documents", spark.createDataFrame(docs, DOCS).toArrow())
    same([tuple(r.values()) for r in con.execute(oracles.MERKLE_MANIFEST).to_arrow_table().to_pylist()], want)


def test_proofs_verify_what_is_untouched(spark):
    docs = spark.createDataFrame(tree_docs([("en", 100), ("de", 3)]), DOCS)
    p = merkle.proofs(docs, Scratch(spark)).withColumn("up", merkle.folded(F.col("leaf"), F.col("way")))
    assert p.where("up <> root").count() == 0 and p.count() == 103
    assert merkle.manifest_digests(docs, Scratch(spark)).where("not verified").count() == 0
    assert merkle.manifest_digests(docs.limit(0), Scratch(spark), tampered()).count() == 0


# --- turns -------------------------------------------------------------------


def plain_repair(turns):
    """The least (cost, audit) over every target up to a length, by a table of whole answers for each."""
    fault, seen = [], set()
    for role, text in turns:
        end = text.rstrip(SPACE)
        fault.append("b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    best = None
    for pairs in range(len(turns) + 2):
        for target in ("ua" * pairs, "s" + "ua" * pairs) if pairs else ("",):
            table = {}
            for i, j in itertools.product(range(len(turns), -1, -1), range(len(target), -1, -1)):
                options = [(0, "")] if i == len(turns) and j == len(target) else []
                if i < len(turns):
                    c, a = table[i + 1, j]
                    options.append((c + 3, "D" + a))
                if j < len(target) and target[j] != "s":
                    c, a = table[i, j + 1]
                    options.append((c + 2, "I" + a))
                if i < len(turns) and j < len(target) and fault[i] not in ("b", "d"):
                    (c, a), t = table[i + 1, j + 1], fault[i] == "t"
                    if turns[i][0][:1] == target[j]:
                        options.append((c + t, "K" + a))
                    if target[j] != "s":
                        options.append((c + 2 + t, "R" + a))
                table[i, j] = min(options) if options else (10**9, "~")
            if best is None or (*table[0, 0],) < best[:2]:
                best = (*table[0, 0], target)
    cost, audit, target = best
    out, i, j = [], 0, 0
    for x in audit:
        if x in "KR":
            out.append((turns[i][0] if x == "K" else {"u": "user", "a": "assistant"}[target[j]], turns[i][1]))
        elif x == "I":
            out.append(({"u": "user", "a": "assistant"}[target[j]], ""))
        i, j = i + (x != "I"), j + (x != "D")
    return cost, audit, out, [fault.count(x) for x in "bdt"]


def random_turns(rng, n):
    role = lambda: rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "User", "", "a"])
    text = lambda: rng.choice(["Yes.", "No!", "Why?  ", "cut off", " ", "", f"t{rng.randrange(9)}.", "ß…"])
    return [(role(), text()) for _ in range(n)]


def test_repairs_against_a_plain_version():
    rng = random.Random(1)
    for k in range(1500):
        turns = random_turns(rng, k % 10)
        got = conversations.examine([(0, *t) for t in turns])
        cost, audit, out, counts = plain_repair(turns)
        assert (got[5], got[6], got[7], list(got[1:4])) == (cost, audit, out, counts), turns


@pytest.mark.parametrize("block", [1, 3, 256])
def test_long_conversations_in_blocks(monkeypatch, block):
    monkeypatch.setattr(conversations, "BLOCK", block)
    rng = random.Random(block)
    for n in (20, 33):
        turns = [("system", "Be good.")] * (n % 2) + [(("user", "assistant")[i % 2], f"{i}.") for i in range(n)]
        turns = [t if rng.random() < 0.7 else rng.choice([("user", t[1]), (t[0], "cut"), (t[0], "")]) for t in turns if rng.random() < 0.9]
        assert conversations.examine([(0, *t) for t in turns])[5:8] == plain_repair(turns)[:3]


def test_a_very_long_conversation_is_cheap():
    turns = [(i, ("user", "assistant")[i % 2], f"cut {i}" if i % 50 == 7 else f"{i}.") for i in range(6000) if i % 97]
    *_, cost, audit, out = conversations.examine(turns)
    assert len(out) % 2 == 0 and all(r == ("user", "assistant")[i % 2] for i, (r, _) in enumerate(out)) and len(audit) >= len(turns) and 0 < cost < 400


def awkward_conversations():
    rng = random.Random(8)
    rows = []
    for c in [*range(60), None, -5]:
        for t in rng.sample(range(12), rng.randrange(1, 7)):
            rows.append((c, rng.choice([t, t, t, None, 3]), rng.choice(["user", "assistant", "system", None]), rng.choice(["Hi.", "Ho!", "a.b?c", None, "", " \t", "x" * 100_000])))
    return rows + rows[:5]


def plain_damage(rows):
    convs = {}
    for c, t, role, text in rows:
        cell = lambda x: " " if x is None else str(x)
        fate, role, text = zlib.crc32(f"{cell(c)}:{cell(t)}".encode()) % 20, cell(role), cell(text)
        here = convs.setdefault(c, [])
        text = "" if fate == 1 else text.translate({ord(x): None for x in ".!?"}) if fate == 2 else text
        here += [(t, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return {c: sorted(v, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, v in convs.items()}


def plain_answer(conv, turns):
    numbers = {t for t, _, _ in turns if t is not None}
    cost, audit, out, counts = plain_repair([x[1:] for x in turns]) if turns else (0, "", [], [0, 0, 0])
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
    return (conv, max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, *counts, illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in out)))


def test_damage_and_repair_against_a_plain_version(spark):
    rows = awkward_conversations()
    df = spark.createDataFrame(rows, CONV).withColumns({"fate": F.lit(0), "audit": F.lit("x")})
    got = conversations.repair_digests(conversations.damage(df))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    same([tuple(r) for r in got.collect()], [plain_answer(c, t) for c, t in plain_damage(rows).items()])
    assert conversations.repair_digests(conversations.damage(df.limit(0))).count() == 0
    undamaged = conversations.repair_conversations(spark.createDataFrame(rows, CONV))
    assert undamaged.count() == 62 and undamaged.where("size(turns) % 2 = 1 and turns[0].role <> 'system'").count() == 0


def test_query_of_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op13_conversation_repair(spark, SF)
    same([tuple(r) for r in got.collect()], [plain_answer(c, t) for c, t in plain_damage(rows).items()])
