"""Manifest, hard negatives and mixes against plain Python, with their edge cases."""

import hashlib
import math
import zlib
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemart.llm import hard_negatives, merkle, mixing
from tidemart.llm.common import running

NO_DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: NULLs, empty and long texts, ties, repeated rows, and names the operators use inside.
DOCS = [
    (1, "a b\nc", "en", "x", 5), (2, None, None, None, None), (3, "", "de", None, 0),
    (4, "ä\n漢 😀", "de", "é", 6), (4, "ä\n漢 😀", "de", "é", 6), (5, "wort " * 20000, "de", "x", 100000),
    (None, "p q", "en", "x", 3), (6, " \n\t", "en", "", 3), (7, "same", "en", "x", 4), (7, "other", "en", "x", 5),
    *[(100 + i, f"line {i}\n" * (i % 5), "en", "z", None) for i in range(40)],
]


@pytest.fixture(scope="module")
def docs(spark):
    extra = {c: F.lit("!") for c in ("pos", "hash", "n", "block", "place", "start", "size", "root", "__tie")}
    return spark.createDataFrame(DOCS, NO_DOCS).repartition(5).withColumns(extra)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    doc_id, text, lang, source, n_chars = row
    values = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join(values))


def plain_tree(hashes):
    """The root, and of each leaf the left and right siblings of its ancestors."""
    paths, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for path, k in zip(paths, at):
            run = k // 3 * 3
            path.append(("".join(hashes[run:k]), "".join(hashes[k + 1 : run + 3])))
        hashes = [sha("".join(hashes[i : i + 3])) for i in range(0, len(hashes), 3)]
        at = [k // 3 for k in at]
    return hashes[0] if hashes else None, paths


def plain_proofs(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[3]].append((-1 if row[0] is None else row[0], plain_leaf(row)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([h for _, h in sorted(groups[s])]) for s in names}
    root, tops = plain_tree([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        for (doc_id, leaf), path in zip(sorted(groups[s]), trees[s][1]):
            out.append((doc_id, leaf, trees[s][0], root, path + top))
    return sorted(out, key=repr)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_proofs_against_a_plain_tree(docs, levels):
    found = merkle.proofs(docs, levels=levels)
    siblings, fold = merkle.siblings_hash(F.col("path")), merkle.folded(F.col("leaf"), F.col("path"))
    rows = found.select("*", siblings.alias("siblings"), fold.alias("fold")).collect()
    got = [
        (-1 if r.doc_id is None else r.doc_id, r.leaf, r.subroot, r.root,
         [(bytes(s.left).decode(), bytes(s.right).decode()) for s in r.path])
        for r in rows
    ]
    assert sorted(got, key=repr) == plain_proofs(DOCS)
    assert all(r.fold == r.root for r in rows)
    assert all(r.siblings == sha("".join(bytes(s.left + s.right).decode() for s in r.path)) for r in rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_trees_of_every_shape(spark, n):
    rows = [(i, f"t{i}", None, "s", i) for i in range(n)]
    found = merkle.proofs(spark.createDataFrame(rows, NO_DOCS), levels=2).collect()
    root, paths = plain_tree([plain_leaf(r) for r in rows])
    assert {(r.doc_id, r.root, len(r.path)) for r in found} == {(i, root, len(paths[i])) for i in range(n)}


def test_a_changed_text_does_not_fold_to_the_root(docs):
    found = merkle.proofs(docs, spoilt=merkle.leaf([F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]))
    fold = merkle.folded(F.col("spoilt"), F.col("path"))
    assert found.where(fold == F.col("root")).count() == 0


def test_no_documents(docs):
    nothing = docs.limit(0)
    assert merkle.proofs(nothing).count() == 0
    assert mixing.mixed(nothing).count() == 0


def test_running_sums_over_equal_keys(spark):
    rows = spark.range(300).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("g"), F.lit(1).alias("o"))
    got = running(rows.repartition(7), ["g"], [F.col("o")], F.lit(2), "at").collect()
    for g, n in ((None, 100), ("hot", 200)):
        assert sorted(r.at for r in got if r.g == g) == list(range(0, 2 * n, 2))
        assert {r.at_total for r in got if r.g == g} == {2 * n}


# Hard negatives

NO_VECTORS = "vec_id long, embedding array<float>, label int"


def plain_negatives(rows, every=50):
    usable = [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label in rows
        if i is not None and v is not None and label is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    anchors = {}
    for i, v, label in usable:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    for a, (label, v) in anchors.items():
        scores = [(-sum(x * y for x, y in zip(v, w)), i, other) for i, w, other in usable]
        alike = sorted((s, i) for s, i, other in scores if other == label and i != a)[:5]
        unlike = sorted((s, i) for s, i, other in scores if other != label)
        for s, p in alike:
            fits = [(n, i) for n, i in unlike if 50 * -s <= 100 * -n <= 95 * -s][:3]
            out += [(a, p, k, i, -s, -n) for k, (n, i) in enumerate(fits, 1)]
    return sorted(out)


def vectors(seed, n=400, repeat=1):
    # Few different components, so that many scores tie.
    state, rows = seed, []
    for i in range(n):
        v = []
        for _ in range(6):
            state = (state * 1103515245 + 12345) % 2**31
            v.append(((state >> 12) % 9 - 3) / 4)
        rows += [(i * 5, v, (state >> 7) % 3)] * repeat
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives_in_many_blocks(spark, monkeypatch, seed):
    monkeypatch.setattr(hard_negatives, "ROWS", 32)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 8)
    rows = vectors(seed)
    found = hard_negatives.hard_negatives(spark.createDataFrame(rows, NO_VECTORS).repartition(3))
    expected = plain_negatives(rows)
    assert sorted(map(tuple, found.collect())) == expected
    assert len(expected) > 300


def test_blocks_of_vectors_are_not_broadcast(spark, monkeypatch):
    # A copy of the anchors for every block of rows looks as small as the anchors.
    monkeypatch.setattr(hard_negatives, "ROWS", 16)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 4)
    plans, written = [], hard_negatives.written

    def seen(df, purpose):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, purpose)

    monkeypatch.setattr(hard_negatives, "written", seen)
    rows = vectors(4)
    found = hard_negatives.hard_negatives(spark.createDataFrame(rows, NO_VECTORS).repartition(5))
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert any("MapInArrow" in p for p in plans)
    assert not [p for p in plans if "Broadcast" in p or "Generate" in p]


@pytest.mark.parametrize("few", [0, 32])
def test_hard_negatives_of_one_hot_vector(spark, monkeypatch, few):
    monkeypatch.setattr(hard_negatives, "ROWS", 64)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 4)
    monkeypatch.setattr(hard_negatives, "LABELS", few)
    rows = [(i, [1.5, 1.0, 0.5], i % 2) if i % 3 else r for i, r in zip(range(0, 1500, 5), vectors(5, 300))]
    found = hard_negatives.hard_negatives(spark.createDataFrame(rows, NO_VECTORS).repartition(3))
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows)


def test_hard_negatives_of_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        *vectors(3, 60, repeat=2), (50, None, 1), (100, [1.0, None], 1), (150, [nan], 0), (200, [inf], 0),
        (None, [1.0], 1), (7, [2.0, 1.0], None), (9, [], 1), (10, [1.0] * 9, 2), (-50, [1.5, 0.5], 0),
    ]
    df = spark.createDataFrame(rows, NO_VECTORS).withColumns({c: F.lit(0) for c in ("q", "anchor", "slot", "score", "rank", "limits", "place")})
    assert sorted(map(tuple, hard_negatives.hard_negatives(df).collect())) == plain_negatives(rows)
    assert hard_negatives.hard_negatives(df.limit(0)).count() == 0
    alone = spark.createDataFrame([(50, [1.0], 1), (3, [1.0], 1)], NO_VECTORS)
    assert hard_negatives.hard_negatives(alone).count() == 0


def test_slots_of_scores_beyond_floats(spark):
    rows = [(0, [2.0**22] * 3, 0), (1, [2.0**22, 2.0**22, 2.0**21], 0), *[(i, [2.0**21 + i] * 3, 1) for i in range(2, 9)]]
    df = spark.createDataFrame(rows, NO_VECTORS)
    assert sorted(map(tuple, hard_negatives.hard_negatives(df).collect())) == plain_negatives(rows)


def test_shares_are_exact():
    import numpy as np

    for p in (0, 1, 19, 20, -1, -7, 2**61 - 3, -(2**61) + 5):
        assert hard_negatives.share(np.int64(p), 95) == p * 95 // 100
        assert -hard_negatives.share(np.int64(-p), 50) == -(-p * 50 // 100)


# Mixes


def plain_targets(sizes, weights, copies=3):
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in sizes if s not in capped]
        level = Fraction(total - sum(copies * sizes[s] for s in capped), sum(weights[s] for s in free) or 1)
        above = {s for s in free if weights[s] * level > copies * sizes[s]}
        if not above:
            return {s: min(weights[s] * level, Fraction(copies * sizes[s])) for s in sizes}
        capped |= above


def plain_seats(votes, house):
    """One seat after the other to the highest quotient."""
    seats = [0] * len(votes)
    for _ in range(house):
        k = max(range(len(votes)), key=lambda i: (votes[i] / (2 * seats[i] + 1), -i))
        seats[k] += 1
    return seats


def check_mix(rows, found, block=16):
    words = {}
    for doc_id, text, _, source, _ in rows:
        words[source] = words.get(source, 0) + len((text or "").encode().split())
    names = sorted(words, key=lambda s: (s is None, s or ""))
    wanted = plain_targets(words, {s: 1 + i % 3 for i, s in enumerate(names)})
    taken = defaultdict(int)
    source_of = {r[0]: r[3] for r in rows}
    for r in found:
        s = source_of[r.doc_id]
        taken[s] += r.taken
        assert r.source_size == words[s]
        assert r.target == pytest.approx(float(wanted[s]))
        assert 0 <= r.taken <= 3 * r.size
        assert r.taken == sum(x.words for x in r.spans)
        assert all(0 <= x["first"] and x["first"] + x.words <= r.size for x in r.spans)
    for s, t in wanted.items():
        assert abs(taken[s] - t) <= block + 1, s


def test_mix_of_edge_cases(docs):
    found = mixing.mixed(docs).collect()
    assert len(found) == len(DOCS)
    check_mix(DOCS, found)
    again = mixing.mixed(docs.repartition(2)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


@pytest.mark.parametrize("votes", [[7, 7, 7], [1000, 1, 1], [53, 24, 23, 11, 2], [0.5] * 9, [90000] + [1] * 30])
def test_seats_go_to_the_highest_quotients(spark, votes):
    rows = [(i, float(v)) for i, v in enumerate(votes)] + [(len(votes), 0.0)]
    sources = spark.createDataFrame(rows, "place long, target double")
    houses = [0, 1, 5, 64, 100]
    got = {r.place: r.seats for r in mixing.apportioned(sources, houses).collect()}
    for i, house in enumerate(houses):
        assert [got[k][i] for k in range(len(votes) + 1)] == [*plain_seats(votes, house), 0]


def test_shards_have_equal_quotas(spark):
    rows = [(i, "w " * (30 + i % 50), "en", "big" if i % 3 else f"s{i % 7}", 0) for i in range(400)]
    df = spark.createDataFrame(rows, NO_DOCS)
    found = mixing.mixed(df, shards=4).collect()
    check_mix(rows, found)
    by_shard = defaultdict(int)
    for r in found:
        for x in r.spans:
            by_shard[x.shard] += x.words
    assert max(by_shard.values()) - min(by_shard.values()) <= 4 * 16
    assert {r.doc_id: r.taken for r in found} != {r.doc_id: r.taken for r in mixing.mixed(df, seed=2).collect()}


def test_words_are_counted_in_whole_texts(spark):
    texts = ["", " ", "a", "a\x0bb\x0cc", " a b ", "wwxw w", "x" * 100000, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(mixing.word_count(F.col("t"))).collect()]
    assert sorted(got) == sorted(len((t or "").encode().split()) for t in texts)


def test_even_crc_decides_on_tampering(spark):
    from tidemart.llm import queries

    rows = queries.QUERIES["op11_merkle_manifest"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in rows:
        spoilt = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (texts[r.doc_id] or "")
        assert r.verified is not spoilt
