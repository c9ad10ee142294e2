"""The ten operators against brute force, on small tables with nulls, ties, repeats and clashing columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import licenses, lm, mixing, neighbours, pieces, quality, repeats, seating, sharding, simhash, topk, vectors

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return (text or "").encode("utf-8").lower().split()


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    bag = ["the", "of", "and", *("".join(rnd.choice(["tion", "er", "an", "ing", "é", "sh"]) for _ in range(rnd.randint(1, 4))) for _ in range(120))]
    text = lambda n: " ".join(rnd.choice(bag) for _ in range(n)).capitalize() + "."
    texts = [text(rnd.randint(1, 120)) for _ in range(50)]
    long = text(3000)
    near = long.replace(long.split()[100], "changed", 1)
    passage = text(40)
    texts += [None, "", "   ", "One", "one two", long, near, texts[0], texts[0], passage + texts[1], texts[2] + passage]
    texts += ["Under the MIT License. See Apache\nlicense, or the GNU General Public License; mit-license", "naïve ☃ 日本 café\t𝔘", "ABC!! DEF!! GHI!!" * 30]
    out = [(i, t, "en", ["a", "b", None, "c"][i % 4], len(t or "")) for i, t in enumerate(texts)]
    return out + [out[3], (None, texts[5], None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def clash(docs, *names):
    """The documents with columns of names that the operators make themselves."""
    return docs.withColumns({n: F.lit("x") for n in (*names, "part", "size", "_part", "key", "fp", "row_key")})


def test_pieces(docs, none, rows):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    raw = open(pieces.default_model(), "rb").read()
    made = {(r.doc_id, r.text): r for r in pieces.encode_documents(clash(docs, "ids", "n_pieces")).collect()}
    assert len(made) == len(set((r[0], r[1]) for r in rows)) and all(r.round_trip for r in made.values())
    own = pieces.Pieces(raw)
    proto = pb.ModelProto()
    proto.ParseFromString(raw)
    proto.trainer_spec.model_type = 1
    best = sentencepiece.SentencePieceProcessor()
    best.LoadFromSerializedProto(proto.SerializeToString())
    score = lambda ids: sum(best.get_score(i) for i in ids)
    for text in ["the", "Whence nterti", "of and thation", "a b"]:
        assert score(own.encode(text)) == score(best.nbest_encode(text, nbest_size=2, out_type=int)[0])
    for text in [None, "", " ", "  a  b ", "x" * 200, "a▁b", "☃☃ naïve 𝔘"]:
        assert own.encode(text) == (own.viterbi(pieces.MARK + text.replace(" ", pieces.MARK)) if text else [])
    decoded = pieces.decode_documents(pieces.encode_documents(docs)).filter("text IS NOT NULL AND text <> decoded").count()
    assert decoded == 0 and pieces.encode_documents(none).count() == 0


def test_mixing(docs, none, rows):
    made = mixing.mix_sources(clash(docs)).collect()
    assert len(made) == len(rows)
    size = collections.Counter()
    for r in rows:
        size[r[3]] += len(words(r[1]))
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    goal, open_, rest = {}, set(order), 1.5 * sum(size.values())
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * size[s] < level * weight[s]}
        if not full:
            goal |= {s: level * weight[s] for s in open_}
            break
        goal |= {s: 2.0 * size[s] for s in full}
        rest -= sum(2.0 * size[s] for s in full)
        open_ -= full
    taken = collections.Counter()
    for r in made:
        assert r.source_size == size[r.source] and math.isclose(r.target, goal[r.source]) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - goal[s]) <= 1 for s in goal)
    again = mixing.mix_sources(docs.repartition(2)).collect()
    key = lambda x: sorted((str(r.doc_id), r.size, r.taken) for r in x)
    assert key(made) == key(again)
    assert mixing.mix_sources(none).count() == 0


def test_lm(docs, none, rows):
    made = lm.score_texts(clash(docs)).collect()
    assert len(made) == len(rows)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = lambda t: [*words(t), b"\n"]
    count = collections.Counter(w for r in rows if not held(r[0]) for w in tokens(r[1]))
    n, v = sum(count.values()), len(count)
    texts = {r[0]: r[1] for r in rows}
    for r in made:
        t = tokens(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(t), sum(w in count for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t)) and r.score < 0
    assert sum(r.score for r in made) > sum(r.base_score for r in made)
    assert lm.score_texts(none).count() == 0


def test_lm_equal_texts_score_equally(spark):
    """Scores do not depend on the doc_id, the blocks or the number of partitions."""
    rnd = random.Random(41)
    bag = [f"w{i}" for i in range(60)]
    texts = [" ".join(rnd.choice(bag[: rnd.choice([5, 20, 60])]) for _ in range(80)) for _ in range(40)]
    table = spark.createDataFrame([(i, texts[i % 40], "", "", 0) for i in range(120)], SCHEMA)
    before, scores = spark.conf.get("spark.sql.shuffle.partitions"), collections.defaultdict(list)
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            for r in lm.score_texts(table, F.col("doc_id") % 9 == 4).collect():
                scores[r.doc_id % 40].append(r.score)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(len(s) == 6 and max(s) - min(s) < 1e-9 for s in scores.values())


def exact_tables(c, parent, other, d, strength):
    """Mean and spread of a dish's tables, from the weights of all numbers of tables by the recurrence."""
    log = np.full(c + 2, -np.inf)
    log[1] = 0
    for n in range(1, c):
        t = np.arange(1, n + 2)
        log[t] = np.logaddexp(log[t - 1], np.log(np.maximum(n - d * t, 1e-300)) + log[t])
    t = np.arange(1, c + 1)
    w = log[1 : c + 1] + np.cumsum(np.log(strength + d * (other + t - 1))) + t * np.log(parent)
    w = np.exp(w - w.max())
    w /= w.sum()
    mean = (w * t).sum()
    return mean, math.sqrt((w * (t - mean) ** 2).sum())


def seatings_of(c, d):
    """All partitions of c customers: (tables, weight of their sizes)."""
    parts = [[]]
    for i in range(c):
        parts = [p[:j] + [p[j] + [i]] + p[j + 1 :] for p in parts for j in range(len(p))] + [[*p, [i]] for p in parts]
    for p in parts:
        yield len(p), math.prod(k - d for t in p for k in range(1, len(t)))


def test_lm_seating():
    dish = lm.mix(np.arange(1, 20001, dtype=np.uint64))
    one = np.ones(len(dish))
    draw = lambda c, p, other, d, s: seating.seat(dish, (one * c).astype(int), one * p, one * other, d, s, 3)
    # One curve for every count of customers: also where tables of ratios begin to be interpolated, and beyond MOST.
    for c in (2, 3, 16, 17, 100, 255, 256, 257, 300, 1000, 4000, 4200):
        for p, other, d, s in ((0.1, 0, 0.5, 1.0), (0.01, 100, 0.5, 1.0), (0.03, 20000, 0.7, 10.0), (0.2, 1000, 0.5, 1.0), (1e-5, 3e6, 0.7, 10.0)):
            made, (mean, spread) = draw(c, p, other, d, s), exact_tables(c, p, other, d, s)
            assert made.min() >= 1 and made.max() <= c
            assert abs(made.mean() - mean) < 0.004 * mean + 5 * spread / math.sqrt(len(dish)), (c, p, made.mean(), mean)
            assert abs(made.std() - spread) < 0.04 * spread + 0.03
    for c in (2, 4, 6):  # against all seatings, one by one
        weight = collections.Counter()
        for t, w in seatings_of(c, 0.4):
            weight[t] += w * math.prod((1.5 + 0.4 * (3 + k)) * 0.2 for k in range(t))
        mean = sum(t * w for t, w in weight.items()) / sum(weight.values())
        assert abs(draw(c, 0.2, 3, 0.4, 1.5).mean() - mean) < 0.03
    assert seating.seat(dish[:3], np.array([0, 1, 5]), one[:3] * 0.5, one[:3] * 0, 0.5, 1.0, 0).tolist()[:2] == [0, 1]


def lm_passes(texts, train, parts):
    """The passes of lm.score_texts over one block, without Spark: the block, what it is told, the rounds' sums."""
    import pyarrow as pa

    docs = pa.table({"doc_id": range(len(texts)), "text": texts, "_train": train, "_part": [0] * len(texts)})

    def owners(rows, f):
        out = [r for p in {r[0] for r in rows} for r in lm.unbatch(f(pa.Table.from_batches([lm.batch([r for r in rows if r[0] == p])])))]
        return [r for r in out if r[0] >= 0], np.sum([np.frombuffer(r[3], np.int64) for r in out if r[0] < 0], axis=0).tolist()

    told, (n, v, once, twice) = owners(lm.unbatch(lm._counts(parts)(docs)), lm._add_counts)
    table = lambda rows: pa.Table.from_batches([lm.batch(rows)])
    own = lm._own_pairs(docs, table(told))
    at, tables = [], []
    for _ in range(lm.ROUNDS + 1):
        made, (c, t, single, double) = owners(lm.unbatch(lm._seat_pairs(parts, list(at))(own, table(tables))), lm._seat_words(list(at), v))
        tables += made
        at.append({"n": n, "v": v, "c": c, "t": t, "d2": lm._discount(once, twice), "d1": at[0]["d1"] if at else lm._discount(single, double)})
    return lm.Block(docs), told + tables, at


@pytest.mark.parametrize("parts", [1, 5])
def test_lm_contexts_sum_to_one(parts):
    """Over all words, the end and one unknown word, after frequent, rare and unknown words alike."""
    rnd = random.Random(2)
    bag = [f"w{i}" for i in range(60)]
    texts = [" ".join(rnd.choice(bag[: rnd.choice([3, 20, 60])]) for _ in range(30)) for _ in range(600)]
    asked = [f"{a} {b}" for a in [*bag, "never"] for b in [*bag, "never"]]
    block, rows, at = lm_passes(texts + asked + bag + ["never"], [True] * 600 + [False] * (len(asked) + 61), parts)
    words, chance = lm.averaged(block, rows, at)
    total = collections.Counter()
    for left, right, p in zip(block.left.tolist(), block.right.tolist(), chance.tolist(), strict=True):
        total[left] += p
    assert len(total) == 62 and len(block.pairs) == 62 * 62 - 1  # all but an end after an end: no text is empty
    end = int(np.flatnonzero(block.words == lm.END)[0])
    assert all(abs(s - 1) < 1e-9 for left, s in total.items() if left != end) and total[end] < 1
    assert words.max() > 2000 and sorted(words)[0] == 0


def test_lm_against_gibbs():
    """Against a plain sampler that takes up and seats every customer in turn."""
    rnd = random.Random(7)
    bag = [f"w{i}" for i in range(12)]
    texts = [" ".join(rnd.choice(bag[: rnd.choice([2, 5, 12])]) for _ in range(8)) for _ in range(60)]
    asked = [" ".join(rnd.choice(bag) for _ in range(6)) for _ in range(30)]
    block, rows, at = lm_passes(texts + asked, [True] * 60 + [False] * 30, 3)
    _, chance = lm.averaged(block, rows, at)
    mine = np.bincount(block.owner, weights=np.log10(chance)[block.pair_of])[60:]
    d2, d1, v = at[0]["d2"], at[0]["d1"], at[0]["v"]
    tokens = lambda t: list(zip(["$", *t.split()], [*t.split(), "$"], strict=True))
    rest, top = collections.defaultdict(lambda: collections.defaultdict(list)), collections.defaultdict(list)

    def up(w):
        c, t = sum(map(sum, top.values())), sum(map(len, top.values()))
        return (max(sum(top[w]) - d1 * len(top[w]), 0) + (lm.STRENGTH_WORD + d1 * t) / (v + 1)) / (lm.STRENGTH_WORD + c)

    def predict(u, w):
        c, t = sum(map(sum, rest[u].values())), sum(map(len, rest[u].values()))
        return (max(sum(rest[u][w]) - d2 * len(rest[u][w]), 0) + (lm.STRENGTH_PAIR + d2 * t) * up(w)) / (lm.STRENGTH_PAIR + c)

    def sit(sizes, new, d):
        """True where a new table opens."""
        at_ = rnd.random() * (sum(sizes) - d * len(sizes) + new)
        for i, n in enumerate(sizes):
            at_ -= n - d
            if at_ < 0:
                sizes[i] += 1
                return False
        sizes.append(1)
        return True

    def leave(sizes):
        i = rnd.choices(range(len(sizes)), sizes)[0]
        sizes[i] -= 1
        if not sizes[i]:
            sizes.pop(i)
            return True
        return False

    def enter(u, w):
        t = sum(map(len, rest[u].values()))
        if sit(rest[u][w], (lm.STRENGTH_PAIR + d2 * t) * up(w), d2):
            sit(top[w], (lm.STRENGTH_WORD + d1 * sum(map(len, top.values()))) / (v + 1), d1)

    train = [p for t in texts for p in tokens(t)]
    for u, w in train:
        enter(u, w)
    known = collections.defaultdict(float)
    for sweep in range(60):
        for u, w in train:
            if leave(rest[u][w]):
                leave(top[w])
            enter(u, w)
        if sweep >= 20:
            for t in asked:
                for p in tokens(t):
                    known[p] += predict(*p) / 40
    for t, score in zip(asked, mine, strict=True):
        want = [math.log10(known[p] / sum(t2.count(" ") >= 0 and tokens(t2).count(p) for t2 in asked)) for p in tokens(t)]
        assert abs(sum(want) - score) < 0.05 * len(want), (t, sum(want), score)


def test_lm_perplexity(docs):
    made = lm.score_texts(docs)
    rows = {r.held_out: r for r in lm.perplexity(made).collect()}
    for side, r in rows.items():
        some = [x for x in made.collect() if x.held_out == side]
        assert math.isclose(r.perplexity, 10 ** (-sum(x.score for x in some) / sum(x.n_tokens for x in some)))


def ints(spark, seed=0, n=300, d=12):
    rng = np.random.default_rng(seed)
    x = rng.integers(-3, 4, (n, d)).astype(float)
    x[50:80] = x[7]
    x[120] = 2 * x[121]
    bad = [(n, None), (n + 1, [None] * d), (n + 2, [float("nan")] * d), (n + 3, [0.0] * d), (None, [1.0] * d)]
    return spark.createDataFrame([*((i, v.tolist()) for i, v in enumerate(x)), *bad], "vec_id long, embedding array<double>"), x


def test_topk(spark):
    table, x = ints(spark)
    good = topk.whole_vectors(table.withColumn("_q", F.lit(1)), 1.0)
    x = np.vstack([x, np.zeros(x.shape[1])])
    ids = [*range(300), 303]
    made = collections.defaultdict(list)
    for r in topk.top_products(good.filter("vec_id % 20 = 0"), good, 20).orderBy("query_id", "rank").collect():
        made[r.query_id].append((r.rank, r.vec_id, r.score))
    for i in range(0, 300, 20):
        s = x @ x[i]
        best = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-s[j], ids[j]))[:20]
        assert made[i] == [(k + 1, ids[j], int(s[j])) for k, j in enumerate(best)]
    few = good.filter("vec_id < 4")
    assert topk.top_products(few, few, 20).count() == 12
    assert topk.top_products(few.limit(0), few.limit(0), 20).count() == 0


def test_topk_bounds():
    rng = np.random.default_rng(1)
    q, c = rng.normal(size=(7, 30)), rng.normal(size=(40, 30))
    for segments in topk.LEVELS:
        bound = np.hstack(topk.summary(q, segments)) @ np.hstack(topk.summary(c, segments)).T
        assert (bound + 1e-9 >= q @ c.T).all()


def test_topk_ties_are_bounded(spark):
    """Products that all tie leave a cell as k + 1 rows a query; ids decide."""
    rng = np.random.default_rng(3)
    q, c, ids = np.eye(10, 40), np.eye(40)[rng.integers(10, 40, 500)] * rng.integers(1, 9, (500, 1)), rng.permutation(500)
    a, b, s = topk.block_top(q, c, ids, 21, step=64)
    assert len(a) == 210 and (s == 0).all() and sorted(ids[b[a == 3]]) == list(range(21))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.eye(120))], "vec_id long, vector array<double>")
    made = topk.top_products(table.filter("vec_id = 40"), table, 20).collect()
    assert sorted(r.vec_id for r in made) == list(range(20)) and {r.score for r in made} == {0}


def test_topk_wide_numbers(spark):
    x = [[1e18, 3.0], [1e18, 5.0], [-1e18, 1.0], [2.0, 0.0]]
    table = topk.whole_vectors(spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>"), 64.0)
    assert [r.vector[0] for r in table.orderBy("vec_id").collect()] == [6.4e19, 6.4e19, -6.4e19, 128.0]
    assert {r.vec_id: r.score for r in topk.top_products(table.filter("vec_id = 3"), table, 3).collect()} == {0: 128 * 64 * 10**18 if 128 * 64 * 10**18 < 1 << 63 else (1 << 63) - 1, 1: (1 << 63) - 1, 2: 1 - (1 << 63)}
    exact = topk.block_top(np.array([[2.0**40, 1.0]]), np.array([[2.0**20, 1.0], [2.0**20, 2.0]]), np.arange(2), 2)
    assert exact[2].tolist() == [2**60 + 2, 2**60 + 1] and exact[1].tolist() == [1, 0]


def test_vectors_of_several_lengths():
    import pyarrow as pa

    with pytest.raises(ValueError):
        vectors.matrix(pa.array([[1.0, 2.0, 3.0], [4.0]]), np.float64)


@pytest.mark.parametrize("clusters", [0, 30])
def test_neighbours(spark, clusters):
    """Recall of held-out and indexed queries, on random directions and on clusters, through the partitions."""
    table, x = ints(spark, 5, 600, 8)
    if clusters:
        rng = np.random.default_rng(clusters)
        x = rng.normal(size=(clusters, 16))[rng.integers(0, clusters, 3000)] + 0.15 * rng.normal(size=(3000, 16))
        table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    good = table.filter(vectors.finite("embedding") & F.col("vec_id").isNotNull()).withColumnRenamed("embedding", "vector").filter(F.exists("vector", lambda v: v != 0))
    good = good.withColumns({c: F.lit("x") for c in ("_p", "_q", "score", "ids", "_least")})
    made = collections.defaultdict(list)
    for r in neighbours.nearest(good.filter("vec_id % 50 = 0"), good, 5, part_rows=120).orderBy("query_id", "rank").collect():
        made[r.query_id].append((r.vec_id, r.score))
    x = x / np.sqrt((x**2).sum(1, keepdims=True))
    found = total = 0
    for i in range(0, len(x), 50):
        s = x @ x[i]
        s[i] = -9
        edge = np.sort(s)[-5]
        assert len(made[i]) == 5 and all(math.isclose(score, s[j], abs_tol=1e-12) for j, score in made[i])
        found += sum(score >= edge - 1e-9 for _, score in made[i])
        total += 5
    assert found / total >= 0.9
    if clusters:
        router, visits = neighbours.fit_index(x, 25)
        assert visits <= 8  # clusters are told apart: a query needs no more than a third of the parts
    assert neighbours.nearest(good.limit(0), good.limit(0)).count() == 0
    few = good.filter("vec_id < 4")
    assert neighbours.nearest(few, few).count() == 12


def test_quality(spark, docs, none, rows):
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(40)] + [(2, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    made = quality.classify(clash(docs, "score", "predicted"), labels)
    got = made.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(none, labels).count() == 0


def test_quality_machine():
    """The linear-time margin equals the sum over pairs."""
    rng = np.random.default_rng(0)
    m = quality.Machine(0.3, rng.normal(size=quality.DIMENSIONS).astype(np.float32), rng.normal(size=(quality.DIMENSIONS, quality.RANK)).astype(np.float32))
    place, value = np.array([3, 9, 36000]), np.array([0.5, 1.0, 2.0], np.float32)
    pairs = sum(float(m.factor[place[i]] @ m.factor[place[j]]) * value[i] * value[j] for i in range(3) for j in range(i))
    assert math.isclose(m.margin(np.array([0, 3]), place, value)[0], 0.3 + float(m.linear[place] @ value) + pairs, rel_tol=1e-4)


def test_quality_learns_noise(spark):
    rnd = random.Random(1)
    good = [" ".join(rnd.choice(["tion", "the", "aner", "ing"]) for _ in range(30)) for _ in range(150)]
    bad = [" ".join(rnd.choice(["TION!!", "THE!!", "ANER!!"]) for _ in range(30)) for _ in range(150)]
    table = spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(good + bad)], SCHEMA)
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(300)], "doc_id long, quality int")
    scored = quality.classify(table, labels).collect()
    right = [(r.predicted == 1) == (r.doc_id < 150) for r in scored if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(right) / len(right) > 0.95


def test_repeats(docs, none, rows):
    made = {}
    for r in repeats.remove_repeats(clash(docs, "n_bytes", "kept", "kept_sha256"), with_text=True).collect():
        made.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, made.values())) == len(rows)
    seen = set()
    for i, text in sorted({(r[0], r[1]) for r in rows if r[0] is not None}, key=lambda r: r[0]):
        raw = (text or "").encode()
        windows = [raw[j : j + 50] for j in range(len(raw) - 49)]
        gone = bytearray(len(raw))
        for j, w in enumerate(windows):
            if w in seen:
                gone[j : j + 50] = b"\1" * 50
        seen.update(windows)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        for r in made[i]:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()), i
    assert made[None][0].n_removed == 0 and repeats.remove_repeats(none).count() == 0
    with pytest.raises(ValueError):
        repeats.remove_repeats(docs.withColumn("doc_id", F.concat(F.lit("a"), "doc_id")))


def test_repeats_over_a_junction(spark):
    """A string over the junction of two removed passages counts as seen, though no smaller document has it."""
    rnd = random.Random(31)
    table, size = [], {}
    for i in range(60):
        text = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(240))
        table += [(4 * i + j, text[a:b], "", "", 0) for j, (a, b) in enumerate([(0, 130), (120, 240), (0, 240), (100, 150)])]
        size |= {4 * i + 3: 50}
    removed = {r.doc_id: r.n_removed for r in repeats.remove_repeats(spark.createDataFrame(table, SCHEMA).repartition(3)).collect()}
    assert {i: removed[i] for i in size} == size


def test_repeats_many_copies(spark):
    """A passage that every document has costs a task one record, and is cut from all but the first."""
    passage = "".join(random.Random(5).choice("abcdefgh ") for _ in range(200))
    table = spark.createDataFrame([(i, f"{i * 7919:08d} {passage} {i * 104729:09d}", "", "", 0) for i in range(300)], SCHEMA)
    removed = {r.doc_id: r.n_removed for r in repeats.remove_repeats(table).collect()}
    assert removed[0] == 0 and all(200 <= removed[i] <= 212 for i in range(1, 300))


def test_licenses(docs, none, rows):
    made = collections.defaultdict(list)
    for r in licenses.scan_licenses(clash(docs)).collect():
        made[r.doc_id].append(r)
    for i, text, *_ in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
        hits = sorted((k, label) for p, label in licenses.PHRASES.items() for k in range(len(found)) if found[k : k + len(p.split())] == p.split())
        want = (len(found), len(hits), hits[0][0] if hits else None, hits[-1][0] if hits else None, ",".join(sorted({h[1] for h in hits})))
        for r in made[i]:
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want
    assert licenses.scan_licenses(none).count() == 0


def test_license_notices():
    scanner = licenses.Scanner()
    number = {w: i for i, w in enumerate(sorted({w for t in [*licenses.PHRASES, *licenses.NOTICES.values()] for w in t.split()}))}
    ids = lambda t: np.array([number.get(w, -1) for w in t.split()])
    found = scanner.scan(ids("zzz " + licenses.NOTICES["isc"].replace("fee", "charge") + " zzz"))
    assert "isc" in found["labels"] and found["spans"][0]["first"] == 1
    assert scanner.scan(ids("the of and to in"))["labels"] == ""


def test_matching_statistics():
    rnd = random.Random(2)
    templates = [[rnd.randrange(4) for _ in range(12)] for _ in range(4)]
    automaton = licenses.Automaton(templates)
    text = [rnd.randrange(4) for _ in range(300)]
    inside = lambda w: any(t[i : i + len(w)] == w for t in templates for i in range(len(t) - len(w) + 1))
    for position, state, matched in automaton.scan(text):
        want = max(n for n in range(13) if n <= position + 1 and inside(text[position + 1 - n : position + 1]))
        assert matched == want
        for number, end in automaton.places[state] if matched else ():
            assert templates[number][end + 1 - matched : end + 1] == text[position + 1 - matched : position + 1]


def test_sharding(docs, none, rows):
    made = sharding.shard_rows(clash(docs), shards=5).collect()
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    slots = collections.defaultdict(list)
    for r in made:
        assert r.size == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id])
        slots[r.shard].append(r.slot)
    assert len(made) == len(rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_rows(none).count() == 0


def test_sharding_is_even_and_groups_stay(spark):
    table = spark.createDataFrame([(i, f"text {i // 3} " * 20, "", "", 0) for i in range(6000)] + [(9000 + i, "copy " * 50, "", "", 0) for i in range(3000)], SCHEMA)
    made = sharding.shard_rows(table, shards=8)
    sizes = [r.s for r in made.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 8 and max(sizes) / min(sizes) < 1.05
    assert made.groupBy("text_crc32", "size").agg(F.count_distinct("shard").alias("n")).filter("n > 1").count() <= 8


def test_simhash(docs, none, rows):
    h = lambda s: xxhash.xxh64_intdigest(s, 42)

    def brute(text):
        w = words(text)
        if not w:
            return 0
        s = [h(b" ".join(w[i : i + 3])) for i in range(max(1, len(w) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in s) > len(s))

    marks = [(r[0], brute(r[1])) for r in rows]
    root = {m: m for _, m in marks}
    find = lambda m: m if root[m] == m else find(root[m])
    for _, a in marks:
        for _, b in marks:
            if bin(a ^ b).count("1") <= 2:
                root[find(a)] = find(b)
    least = {}
    for i, m in marks:
        if i is not None:
            least[find(m)] = min(i, least.get(find(m), i))
    made = simhash.simhash_groups(clash(docs)).collect()
    assert sorted((str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in made) == sorted((str(i), m, str(least.get(find(m)))) for i, m in marks)
    assert simhash.simhash_groups(none).count() == 0


def test_cells_link_all_near_fingerprints():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fp = np.unique(np.concatenate([base, *(base ^ np.uint64(1 << int(i)) for i in rng.integers(0, 64, 30))]))
    cell = np.zeros(len(fp), np.int64)
    pairwise = simhash.cell_links(cell, fp, 2)
    balls = simhash.cell_links(cell, fp, 2, wide=1)
    parts = lambda links: {(int(a), int(b)) for a, b in zip(*links, strict=True)}
    assert parts(pairwise) == parts(balls) and len(parts(balls))


def test_parity_bits_bound_the_difference():
    rng = np.random.default_rng(4)
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, 400).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(0, 300))) for _ in range(2))
        apart = np.bitwise_count((simhash.parity_bits(a) ^ simhash.parity_bits(b)).view(np.uint64)).sum()
        assert apart <= len(np.setxor1d(a, b))


def test_near_copies(spark):
    rnd = random.Random(9)
    text = lambda: [rnd.choice("abcdefghijklmnop") + rnd.choice("abcdefgh") + str(rnd.randrange(60)) for _ in range(400)]
    base = [text() for _ in range(20)]
    near = [[*b[:50], "new", *b[51:300], "other", *b[301:]] for b in base]
    table = spark.createDataFrame([(i, " ".join(t), "", "", 0) for i, t in enumerate(base + near)] + [(99, " ".join(base[0]), "", "", 0)] * 2, SCHEMA)
    assert sorted(r.doc_id for r in simhash.drop_near_copies(table).collect()) == list(range(20))
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, None), (None, "a b c", None, None, None), (3, "a b c", None, None, None)], SCHEMA)
    assert sorted(r.doc_id for r in simhash.drop_near_copies(odd).collect()) == [1, 3]
    assert simhash.drop_near_copies(table.limit(0)).count() == 0


def test_near_copies_cut_and_continued(spark):
    """Copies that stop early or go on are found down to the similarity asked for, and none below it."""
    rnd = random.Random(17)
    table, stay = [], []
    for i, n in enumerate([100, 201, 400, 1001] * 6):
        text = [f"w{rnd.randrange(10**6)}" for _ in range(n)]
        much = [0.8, 0.81, 0.85, 0.9, 0.95, 0.79][i // 4]
        total = (math.floor if much >= 0.8 else math.ceil)((n - 4) / much) + 4
        copy = text + [f"v{rnd.randrange(10**6)}" for _ in range(total - n)]
        assert ((n - 4) / (total - 4) >= 0.8) == (much >= 0.8)
        pair = [text, copy] if i % 2 else [copy, text]
        table += [(2 * i + j, " ".join(t), "", "", 0) for j, t in enumerate(pair)]
        stay += [2 * i] if much >= 0.8 else [2 * i, 2 * i + 1]
    made = simhash.drop_near_copies(spark.createDataFrame(table, SCHEMA).repartition(3))
    assert sorted(r.doc_id for r in made.collect()) == stay


def test_near_copies_behind_another_partner(spark):
    """A copy is found though other texts of the same words, which are no copies, come before it."""
    rnd = random.Random(23)
    table = []
    for i in range(5):
        bag = [f"k{i}x{rnd.randrange(10**6)}" for _ in range(300)]
        orders = [rnd.sample(bag, len(bag)) for _ in range(4)]
        table += [(10 * i + j, " ".join(o), "", "", 0) for j, o in enumerate(orders)]
        table.append((10 * i + 9, " ".join(orders[3] + orders[3][40:52]), "", "", 0))
    made = simhash.drop_near_copies(spark.createDataFrame(table, SCHEMA).repartition(3))
    assert sorted(r.doc_id for r in made.collect()) == [10 * i + j for i in range(5) for j in range(4)]


def test_near_dedup_goes_by_fingerprints(spark, tmp_path, monkeypatch):
    """Without any shared cell SimHash alone finds near copies; texts of one fingerprint that are no copies stay."""
    import corpus_pipeline

    def no_cells(batches):
        for _ in batches:
            yield from ()

    monkeypatch.setattr(simhash, "_shared_cells", no_cells)
    rnd = random.Random(31)
    base = [[f"w{rnd.randrange(10**6)}" for _ in range(900)] for _ in range(12)]
    near = [[*b[:400], b[400] + "x", *b[401:]] for b in base]
    spam = [["buy"] * 500 + [f"s{i}x{j}" for j in range(60)] for i in range(4)]
    texts = [" ".join(t) for t in base + near + spam]
    marks = [simhash.fingerprint(t) for t in texts]
    linked = [i for i in range(12) if (marks[i] ^ marks[12 + i]).bit_count() <= 2]
    assert len(linked) > 6 and len(set(marks[24:])) == 1
    table = spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    made = dict(corpus_pipeline.STAGES)["near_dedup"](spark, table, str(tmp_path))
    assert sorted(r.doc_id for r in made.collect()) == [i for i in range(28) if i - 12 not in linked]


def test_pipeline(spark, tmp_path, rows):
    import corpus_pipeline

    good = [r for r in rows if r[0] is not None]
    spark.createDataFrame(good, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(63, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    made = corpus_pipeline.run(spark, str(tmp_path))
    assert made.filter("NOT round_trip").count() == 0 and 20 < made.select("doc_id").distinct().count() <= len(good)
    empty = tmp_path / "empty"
    spark.createDataFrame([], SCHEMA).write.parquet(str(empty / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(empty / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_license_table(spark):
    """Whole licence texts as a table: a file with one of them, framed and a little changed, is labelled and spanned."""
    rnd = random.Random(6)
    bag = ["the", "of", "license", "copy", *(f"term{i}" for i in range(300))]
    texts = {name: " ".join(rnd.choice(bag) for _ in range(900)) for name in ("long-a", "long-b")}
    table = spark.createDataFrame([*texts.items(), (None, "a b"), ("short", "one"), ("long-a", texts["long-a"])], "label string, text string")
    notices = licenses.notices_of(table)
    assert sorted(n for n, _ in notices) == ["long-a", "long-b"]
    changed = texts["long-a"].upper().split()
    changed[400] = "changed"
    rows = [(1, "frame " * 50 + "; ".join(changed) + " tail" * 9), (2, texts["long-b"][:300]), (3, None)]
    made = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), notices=notices).collect()}
    assert made[1].labels == "long-a" and made[2].labels == "" and made[3].n_words == 0
    span, = made[1].spans
    assert (span.first, span.last) == (50, 949) and span.covered > 0.99
    with pytest.raises(ValueError):
        licenses.notices_of(table, 100)


@pytest.mark.parametrize("stage", range(5))
def test_stages_leave_other_columns_alone(spark, tmp_path, docs, none, stage):
    """Columns of names that operators make pass through each stage as they are; empty tables go through."""
    import corpus_pipeline

    names = ["score", "predicted", "kept", "n_removed", "_key", "_each", "_n", "_times", "row_key", "_row_key", "_part", "part", "_aside_0"]
    spark.createDataFrame([(i, 1) for i in range(60)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    wide = docs.withColumns({n: F.concat(F.lit(f"{n} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for n in names})
    name, run = corpus_pipeline.STAGES[stage]
    made = run(spark, wide, str(tmp_path))
    if name != "pieces":
        assert made.columns == wide.columns
        rows = made.collect()
        assert rows and all(r[n] == f"{n} {'-' if r.doc_id is None else r.doc_id}" for r in rows for n in names)
    assert run(spark, none, str(tmp_path)).count() == 0
