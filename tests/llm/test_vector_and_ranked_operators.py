"""toxicity, centroid clustering and ranked search, against plain recurrences and brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lexiquarry.llm import clusters, ranked, toxicity
from lexiquarry.llm._words import each_slice

DOCS = "doc_id long, text string, toxic string, label string"
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))


def prose(rng, n):
    return " ".join("".join(rng.choice(["ra", "to", "mi", "ne", "su", "ka", "lo"]) for _ in range(rng.randint(1, 3))) for _ in range(n))


# toxicity


def plain_features(text, hashes):
    """Bucket to value, one word at a time."""
    words = [hashes[t] for t in terms_of(text)]
    out = {}
    for gap, factor in ((0, 3), (1, 5), (2, 11)):
        for a, b in zip(words, words[gap:]):
            x = a * 3 if not gap else a * factor + b * (factor + 2)
            x &= (1 << 64) - 1
            for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
                x = ((x ^ (x >> 33)) * m) & ((1 << 64) - 1)
            out.setdefault((x ^ (x >> 33)) >> (64 - toxicity.BITS), 1.0 if not gap else toxicity.PAIR)
    return out


def plain_ftrl(rows):
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= toxicity.L1:
            return 0.0
        return -(z[i] - math.copysign(toxicity.L1, z[i])) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    for x, label in rows:
        x = {**x, "bias": 1.0}
        w = {i: weight(i) for i in x}
        p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w[i] * v for i, v in x.items())))))
        for i, v in x.items():
            g = (p - label) * v * (toxicity.TOXIC if label else 1.0)
            z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA * w[i]
            n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def toxic_rows(rng, n):
    """Plain prose; of every fifth, some insults among it, in any case and beside any mark."""
    rows = []
    for i in range(n):
        words, label = prose(rng, rng.randint(3, 200)).split(), int(i % 5 == 0)
        for _ in range(2 * label):
            words.insert(rng.randrange(len(words)), rng.choice(["Zork!", "zork", "(blit)", "BLIT", "élan"]))
        rows.append((i, " ".join(words), label))
    return rows


def test_features_and_learner_agree_with_plain_ones():
    rng = random.Random(5)
    texts = [t for _, t, _ in toxic_rows(rng, 60)] + ["", "one", "a, b", "Ab ab AB ab"]
    hashes = {}
    found = []
    for _, w in each_slice(pa.array(texts), marks=True):
        data = w.data.tobytes()
        for a, b, h in zip(w.start, w.end, w.hash):
            hashes[re.sub(rb"[A-Z]", lambda m: m[0].lower(), data[a:b])] = int(h)
        rows, buckets, value = toxicity.present(*toxicity.occurrences(w))
        found += [dict(zip(buckets[rows == r].tolist(), value[rows == r].tolist())) for r in range(len(w.rows) - 1)]
    assert found == [plain_features(t, hashes) for t in texts]
    labels = [int("ork" in t or "lit" in t.lower()) for t in texts]
    model = toxicity.Ftrl()
    for x, label in zip(found, labels):
        model.learn(np.array(list(x), np.int64), np.array(list(x.values())), label)
    want = plain_ftrl(zip(found, labels))
    got = model.weights()
    assert all(abs(got[-1 if i == "bias" else i] - w) < 1e-9 for i, w in want.items()) and np.count_nonzero(got) == sum(w != 0 for w in want.values())


def test_toxicity_learns_insults_and_leaves_the_rest(spark):
    rng = random.Random(6)
    rows = toxic_rows(rng, 1500)
    long = prose(rng, 20000).split()
    more = [(5000, " ".join([*long, "zork", "blit", *long]), None), (5001, " ".join(long), None), (5002, None, None), (5003, "", None), (None, "zork! blit!", None)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t, _ in rows + more] + [(0, rows[0][1], "x", "y")], DOCS)
    labels = spark.createDataFrame([(i, label) for i, _, label in rows] + [(None, 1), (1, None), (9999, 1), (2, 0)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert 0 < len(model.buckets) < 500
    got = toxicity.score(docs, model).collect()
    assert len(got) == docs.count()
    score = {r["doc_id"]: r["score"] for r in got}
    assert score[5000] >= 0.5 > score[5001] and score[None] >= 0.5
    assert score[5002] == score[5003] == pytest.approx(1 / (1 + math.exp(-model.bias)))
    held = [(score[i], label) for i, _, label in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 100 and all((s >= 0.5) == bool(label) for s, label in held)
    clean = toxicity.keep_clean(docs, model)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {i for i, s in score.items() if s < 0.5}
    again = toxicity.train(docs.repartition(7), labels)
    assert np.array_equal(again.buckets, model.buckets) and np.array_equal(again.weights, model.weights)


def test_toxicity_without_labels_or_rows(spark):
    docs, none = spark.createDataFrame([(1, "a b", "", "")], DOCS), spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in toxicity.score(docs, toxicity.train(docs, none)).collect()] == [0.5]
    assert toxicity.score(docs.where("doc_id > 1"), toxicity.train(docs.where("doc_id > 1"), none)).collect() == []


# clusters


def brute_clusters(vectors, k=clusters.K, rounds=clusters.ROUNDS):
    good = [(i, [max(-clusters.MOST, min(clusters.MOST, math.floor(64 * float(v)))) for v in e]) for i, e in vectors if e is not None and len(e) == 64 and all(v is not None and math.isfinite(v) for v in e)]
    order = sorted(good, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [x for _, x in order[:k]]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))

    def nearest():
        return [min(range(len(centres)), key=lambda j: (far(x, centres[j]), j)) for _, x in good]

    for _ in range(rounds):
        own = nearest()
        for j in range(len(centres)):
            mine = [x for (_, x), o in zip(good, own) if o == j]
            if mine:
                centres[j] = [sum(c) // len(mine) for c in zip(*mine)]
    own = nearest()
    most = (1 << 63) - 1
    d = [min(most, far(x, centres[o])) for (_, x), o in zip(good, own)]
    per = {j: min(most, sum(v for v, o in zip(d, own) if o == j)) for j in set(own)}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((repr(i), o, v, per[o], min(most, sum(d)), sha[o]) for (i, _), o, v in zip(good, own, d))


def vector_rows(spread, n, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, spread, (20, 64))
    return [(i, (middle[rng.integers(20)] + rng.normal(0, spread / 3, 64)).tolist()) for i in range(n)]


@pytest.mark.parametrize(
    "rows",
    [
        vector_rows(1.0, 700),
        [(i, [float(v) for v in np.random.default_rng(i).integers(0, 2, 64) / 64]) for i in range(300)],  # many ties
        vector_rows(0.3, 200) + [(1000 + i, [0.25] * 64) for i in range(90)],  # repeated vectors
        vector_rows(1.0, 60) + [(100, [1e30] * 64), (101, [-1e12, 1e9] * 32), (102, [1e300] + [0.0] * 63)],  # beyond 64 bits
        vector_rows(1.0, 5) + [(3, [0.5] * 64), (3, [0.5] * 64), (None, [0.0] * 64)],  # fewer than centroids
        vector_rows(1.0, 1),
        vector_rows(1.0, 40) + [(50, None), (51, []), (52, [1.0] * 63), (53, [1.0] * 65), (54, [None] + [1.0] * 63), (55, [math.nan] + [1.0] * 63), (56, [-math.inf] + [1.0] * 63)],
    ],
    ids=["spread", "ties", "repeats", "huge", "few", "one", "unusable"],
)
def test_clusters_equal_brute_force(spark, rows):
    df = spark.createDataFrame([(i, e, 0, 0) for i, e in rows], "vec_id long, embedding array<double>, cluster int, x int").repartition(3)
    got = clusters.cluster(df)
    found = sorted((repr(r["vec_id"]), *(r[c] for c in ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))) for r in got.collect())
    assert found == brute_clusters(rows)


def test_no_vectors_give_no_clusters(spark):
    assert clusters.cluster(spark.createDataFrame([(1, [0.0])], "vec_id long, embedding array<float>")).collect() == []


def test_bounds_leave_most_distances_out_and_never_lie():
    x = np.floor(64 * np.array([e for _, e in vector_rows(2.0, 2000)])).astype(np.int64)
    centres, before = [row.tolist() for row in x[:16]], None
    own, upper, lower = np.full(len(x), -1), np.zeros(len(x), np.float32), np.zeros((len(x), 16), np.float32)
    took = []
    for _ in range(4):
        step = clusters.Round(centres, before)
        own, upper, lower, n = step.assign(x, own, upper, lower)
        took.append(n)
        true = np.sqrt(np.array([clusters.squared(x, np.array(c)) for c in centres], np.float64)).T
        assert (own == [min(range(16), key=lambda j: (t[j], j)) for t in true]).all()
        assert (upper.astype(np.float64) >= true[np.arange(len(x)), own]).all() and (lower.astype(np.float64) <= true).all()
        before, centres = centres, [(x[own == j].sum(axis=0) // max(1, (own == j).sum())).tolist() if (own == j).any() else centres[j] for j in range(16)]
    assert took[0] < 0.75 * 16 * len(x) and took[-1] < took[0] / 10  # the first round has no bounds yet but the distances between centroids


# ranked search


def brute_rank(docs, items, k=ranked.K):
    held = [(i, terms_of(t)) for i, t in docs]
    held = [(i, t) for i, t in held if t]
    n_docs, total = len(held), sum(len(t) for _, t in held)
    wanted = {}
    for i, t in items:
        if i is not None and terms_of(t):
            wanted.setdefault(i, set()).update(terms_of(t))
    out = []
    for i, terms in wanted.items():
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in d for _, d in held) + 1))) for t in terms}
        scored = []
        for doc, d in held:
            m = 100 - 90 + (90 * len(d) * n_docs) // total
            s = sum(w[t] * ((10**9 * d.count(t)) // (1000 * d.count(t) + 8 * m)) for t in terms if t in d)
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(i, r + 1, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=lambda r: r[:2])


def ranked_rows():
    rng = random.Random(8)
    docs = [(i, prose(rng, rng.randint(1, 60))) for i in range(120)]
    docs += [(200 + i, docs[7][1].upper() + "!") for i in range(15)] + [(300, None), (301, ""), (302, "?! -"), (None, docs[7][1]), (303, prose(rng, 4000)), (7, docs[7][1])]
    docs += [(400, "x" * 3000 + " É é Ünï 9to5"), (401, "é" + "x" * 3000), (402, "a_b-c`d\x7fe\x00f")]
    items = [(i, prose(rng, rng.randint(1, 12))) for i in range(25)] + [(50, None), (51, ""), (52, "zzz"), (None, "ra to"), (53, docs[7][1]), (54, "X" * 3000 + " É d"), (55, "ra"), (55, "mi ra to ra"), (56, prose(rng, 500)), (57, "ÜNÏ 9TO5 e F")]
    return docs, items


@pytest.mark.parametrize("block_bytes", [ranked.BLOCK_BYTES, 300])
def test_ranked_search_equals_brute_force(spark, block_bytes):
    docs, items = ranked_rows()
    got = ranked.rank(
        spark.createDataFrame([(i, t, "a", "b") for i, t in docs], "doc_id long, text string, item_id string, score string").repartition(3),
        spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int").repartition(2),
        block_bytes=block_bytes,
    )
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[:2]) == brute_rank(docs, items)


def test_ranked_search_of_nothing(spark):
    docs, items = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked.rank(docs.where("doc_id > 1"), items).collect() == []
    assert ranked.rank(docs, items.where("item_id > 1")).collect() == []


def test_terms_of_one_hash_are_told_apart():
    """Two terms under one hash: bytes decide."""
    (_, w), = each_slice(pa.array(["abc abd abc", "abd"]), marks=True)
    same = w._replace(hash=np.full(len(w.hash), 7, np.uint64))
    v = ranked.Vocabulary(np.array([1, 1, 2]), np.full(3, 7, np.uint64), [b"abc", b"abd", b"abd"])
    row, term, count = v.postings(same)
    assert sorted(zip(row.tolist(), term.tolist(), count.tolist())) == [(0, 0, 2), (0, 1, 1), (1, 1, 1)]


def test_radix_order_is_the_stable_order():
    keys = np.random.default_rng(2).integers(0, 1 << 40, 5000).astype(np.uint64) % np.uint64(1 << 35)
    keys[::3] = keys[0]
    assert np.array_equal(ranked.radix_order(keys), np.argsort(keys, kind="stable"))
