"""The training-data operators against brute force, on texts with nulls, empties, ties, copies and repeated rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORDS.findall(t or "")


def lower(t):
    return (t or "").encode().lower().decode()


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_repeats(unique, docs, empty, monkeypatch):
    from lakequery.llm import substring_dedup as m

    def brute(pairs):
        first, out = {}, {}
        for k, t in sorted(pairs, key=lambda x: x[0]):
            w, gone = words(t), set()
            for i in range(len(w) - 49):
                if first.setdefault(tuple(w[i : i + 50]), k) < k:
                    gone |= set(range(i, i + 50))
            kept = " ".join(x for i, x in enumerate(w) if i not in gone)
            out[k] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
        return out

    expected = brute(texts(unique))
    for hot in (m.HOT, 1):  # with 1, every repeated fingerprint takes the path of very frequent ones
        monkeypatch.setattr(m, "HOT", hot)
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in m.remove_repeats(unique).collect()}
        assert got == expected
    monkeypatch.undo()
    assert sum(n for _, n, _ in expected.values()) > 500
    full = m.remove_repeats(docs).collect()
    assert len(full) == docs.count()
    assert [r.n_removed for r in full if r.doc_id is None and r.n_words == 120] == [120]
    assert m.remove_repeats(empty).count() == 0


def test_wavelet_rank():
    from lakequery.llm.substring_dedup import WaveletMatrix

    v = np.random.default_rng(1).integers(0, 37, 500)
    w = WaveletMatrix(v, 37)
    c, at = np.random.default_rng(2).integers(0, 37, 200), np.random.default_rng(3).integers(0, 501, 200)
    got = w.rank(c, at) - w.rank(c, np.zeros(200, dtype=np.int64))
    assert got.tolist() == [int((v[:p] == x).sum()) for x, p in zip(c, at, strict=True)]


def sets_of(pairs):
    out = {}
    for k, t in pairs:
        w = words(lower(t))
        out[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())
    return out


def linked_classes(pairs, percent):
    """Component of each row, by position, from all pairs of rows."""
    sets = [sets_of([(0, t)])[0] for _, t in pairs]
    where, parent = defaultdict(list), list(range(len(sets)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, s in enumerate(sets):
        for j in {j for g in s for j in where[g]}:
            n = len(s & sets[j])
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
        for g in s:
            where[g].append(i)
    groups = defaultdict(list)
    for i in range(len(sets)):
        groups[find(i)].append(i)
    return sets, groups


def expected_near(pairs, percent):
    """Rows of near_duplicates, by brute force."""
    sets, groups = linked_classes(pairs, percent)
    out = []
    for members in groups.values():
        least = min((pairs[i][0] for i in members if pairs[i][0] is not None), default=None)
        out += [(pairs[i][0], len(sets[i]), least, pairs[i][0] == least) for i in members]
    return sorted(out, key=str)


def test_near_duplicates(unique, docs, empty):
    from lakequery.llm.minmax_dedup import near_duplicates, without_near_duplicates

    for df in (unique, docs):  # docs with repeated rows and null ids
        got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df).collect()), key=str)
        assert got == expected_near(texts(df), 85)
    assert len({x[2] for x in got}) < len(got) - 10
    left = without_near_duplicates(docs).collect()
    assert set(left[0].asDict()) == set(docs.columns)
    assert sum(r.text == "only here once" for r in left) == 1 and len({(r.doc_id, r.text) for r in left}) == len(left) - sum(not words(r.text) for r in left) + len({(r.doc_id, r.text) for r in left if not words(r.text)})
    assert near_duplicates(empty).count() == 0 and without_near_duplicates(empty).count() == 0


def test_near_duplicates_shared_ids(spark):
    """Rows without an id, or with one id for many texts, lose no link and gain none."""
    from lakequery.llm.minmax_dedup import near_duplicates, without_near_duplicates

    r = random.Random(3)
    made = []
    for i in range(24):
        w = [f"w{r.randrange(10**5)}" for _ in range(80)]
        made += [((None, 5, i + 100)[i % 3], " ".join(w)), ((5, None, None)[i % 3], " ".join([*w[:-1], "changed"]))]
    made += [(None, None), (5, ""), (None, made[0][1]), (7, made[2][1].upper()), (5, "a b"), (5, "A  B")]
    df = spark.createDataFrame(made, "doc_id long, text string").repartition(5)
    got = near_duplicates(df).collect()
    assert sorted(((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in got), key=str) == expected_near(made, 85)
    classes = [len(m) for m in linked_classes(made, 85)[1].values()]
    assert sorted(Counter(x.group for x in got if x.group is not None).values()) == sorted(classes)[2:]  # two rows have no words
    clash = df.select("*", F.lit(1).alias("_rid"), F.lit(2).alias("row"), F.lit(3).alias("group"), F.lit(4).alias("rid"))
    left = without_near_duplicates(clash, percent=85)
    assert left.columns == clash.columns and left.count() == len(classes)
    assert {(x["_rid"], x["row"], x["group"], x["rid"]) for x in left.collect()} == {(1, 2, 3, 4)}


@pytest.mark.parametrize("direct", [10**6, 40])
def test_near_duplicates_edited(spark, direct):
    """A large group of copies edited too much for a link with most others, without and with its original; edits of edits too. With
    few direct pairs, groups are split again and again."""
    from lakequery.llm.minmax_dedup import near_duplicates

    r = random.Random(9)
    base = [f"b{r.randrange(10**6)}" for _ in range(150)]
    tree = [base]

    def edited(w, n):
        w = list(w)
        for _ in range(n):
            w[r.randrange(len(w))] = f"e{r.randrange(40)}" if r.random() < 0.5 else f"e{r.randrange(10**6)}"
        return w

    for i in range(220):
        tree.append(edited(base if i < 120 else tree[r.randrange(1, 121)], r.randint(1, 4)))
    for rows in (tree[1:], tree):
        made = [(1000 - i, " ".join(w)) for i, w in enumerate(rows)]
        got = near_duplicates(spark.createDataFrame(made, "doc_id long, text string"), direct=direct).collect()
        want = expected_near(made, 85)
        assert sorted(((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in got), key=str) == want
    assert 10 < len({x[2] for x in want}) < len(want) - 10


def test_components(spark):
    from lakequery.llm.common import components

    chain = [(hash((i, "x")) % 10**9, hash((i + 1, "x")) % 10**9) for i in range(40)]
    other = [(5 * 10**9, 5 * 10**9 + 1), (5 * 10**9, 5 * 10**9 + 2)]
    got = components(spark.createDataFrame(chain + other, "u long, v long")).collect()
    assert len({r.root for r in got}) == 2 and len(got) == 44
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_shards(docs, empty):
    from lakequery.llm.hash_tree import Tree, assign_shards

    rows = assign_shards(docs).collect()
    assert len(rows) == docs.count()
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
        assert r.size == 8 + len((r.text or "").encode()) and r.text_crc32 == zlib.crc32((r.text or "").encode()) and r.law == "key"
        assert r.grown_shard in (r.shard, 24) and 0 <= r.shard < 24
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    heavy = Tree((((3.0,),), ((1.0, 1.0),)))

    def brute(k, tree):
        """Shard and smallest draw by level, every child drawn."""
        draw = lambda name, w: -math.log((int(hashlib.md5(f"{'null' if k is None else k}|{name}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13) / w
        at, level = [], tree.regions
        total = lambda x: x if isinstance(x, float) else math.fsum(map(total, x))
        for _ in range(3):
            at.append(min(range(len(level)), key=lambda i: draw(".".join(map(str, [*at, i])), total(level[i]))))
            level = level[at[-1]]
        flat = [(g, r, x) for g, region in enumerate(tree.regions) for r, rack in enumerate(region) for x in range(len(rack))]
        return flat.index(tuple(at))

    uneven = Tree((((1.0, 2.0), (0.5,)), ((4.0,), (1.0, 1.0, 1.0))))
    for tree in (Tree(), heavy, uneven):
        assert all(r.shard == brute(r.doc_id, tree) and r.grown_shard == brute(r.doc_id, tree.grown()) for r in assign_shards(docs, tree).collect())
    clash = assign_shards(docs.select("*", *(F.lit(7).alias(c) for c in ("row", "id", "_part", "__CRC", "region", "rack", "_t_shard", "slot"))))
    assert set(clash.columns) == {*docs.columns, "row", "id", "_part", "__CRC", "region", "rack", "_t_shard", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}
    assert {(r.row, r.id, r["_part"], r["__CRC"], r.region, r.rack, r["_t_shard"]) for r in clash.collect()} == {(7,) * 7} and {(r.doc_id, r.shard) for r in clash.collect()} == {(r.doc_id, r.shard) for r in rows}
    n = Counter(r.shard for r in assign_shards(docs.sparkSession.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")), heavy).collect())
    assert abs(n[0] / 4000 - 0.6) < 0.04 and set(n) == {0, 1, 2}
    assert assign_shards(empty).count() == 0


def test_decontamination(spark, docs, empty):
    from lakequery.llm import simhash_decontam as m

    rows = texts(docs)
    donor = " ".join(words(next(t for _, t in rows if t and len(words(t)) == 9000))[100:140])
    changed = donor.split()
    changed[3] = "changed"
    items = [(1, donor.upper().replace(" ", ", ")), (2, "no such words in any text at all here"), (3, None), (4, ""), (5, " ".join(changed)), (6, "only here"), (None, "a b c d")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    norm = lambda t: (t or "").encode().translate(m.TABLE).decode().split()

    def grams(w):
        return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else Counter([tuple(w)])

    expected = Counter()
    for k, t in rows:
        w = norm(t)
        for item, x in items:
            n = len(norm(x))
            best = max((sum((a & b).values()) / sum((a | b).values()) for i in range(len(w) - n + 1) for a, b in [(grams(w[i : i + n]), grams(norm(x)))]), default=0) if n else 0
            if best >= 0.8:
                expected[k, item] += 1
    got = m.find_matches(docs, bench).collect()
    assert Counter((r.doc_id, r.item_id) for r in got) == expected and expected
    assert Counter((r.doc_id, r.item_id) for r in m.find_matches(docs, bench, block_bytes=100).collect()) == expected
    left = m.without_matches(docs, bench)
    assert left.columns == docs.columns
    flagged = {k for k, _ in expected}
    assert left.count() >= docs.count() - sum(expected.values()) and not {r.doc_id for r in left.where("doc_id is not null").collect()} & flagged
    assert m.find_matches(empty, bench).count() == 0 and m.find_matches(docs, bench.limit(0)).count() == 0


def test_decontamination_shorter(spark):
    """A document that is an item less a few words, against brute force over windows that are the whole document where it is shorter."""
    from lakequery.llm import simhash_decontam as m

    r = random.Random(4)
    item = [f"w{r.randrange(10**6)}" for _ in range(100)]
    same = ["again"] * 30
    items = [(1, item), (2, item[:60]), (3, same), (4, item[:6])]
    rows = [(i, item[i // 2 : i // 2 + 100 - i]) for i in range(0, 40, 2)] + [(100, item[:45] + item[50:]), (101, item[:20] + item[40:]), (102, same[:26]), (103, same[:24]), (104, item[:5]), (105, ["other", *item[:89]])]
    grams = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    expected = {}
    for k, w in rows:
        for j, x in items:
            n = min(len(x), len(w))
            s, at = max((sum((a & b).values()) / sum((a | b).values()), -i) for i in range(len(w) - n + 1) for a, b in [(grams(w[i : i + n]), grams(x))])
            if s >= 0.8:
                expected[k, j] = (round(s, 9), -at, n)
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(j, " ".join(x)) for j, x in items], "item_id long, text string")
    got = {(x.doc_id, x.item_id): (round(x.similarity, 9), x.first_word, x.n_words) for x in m.find_matches(docs, bench).collect()}
    assert got == expected and sum(n < 100 for (_, j), (_, _, n) in got.items() if j == 1) > 5 and (102, 3) in got and (105, 1) in got
    assert {x.doc_id for x in m.without_matches(docs, bench).collect()} == {k for k, _ in rows} - {k for k, _ in expected}
    assert m.find_matches(docs, bench.where("item_id = 1")).count() == sum(j == 1 for _, j in expected)


def test_multi_index():
    from lakequery.llm.simhash_decontam import MultiIndex

    r = np.random.default_rng(0)
    a = r.integers(0, 2**63, 40, dtype=np.uint64)
    q = np.concatenate([a ^ np.uint64(int(sum(1 << int(b) for b in r.choice(63, n, replace=False)))) for n in (0, 10, 23)])
    got = set(zip(*map(np.ndarray.tolist, MultiIndex(a).within(q)), strict=True))
    assert got == {(i, j) for i in range(len(q)) for j in range(len(a)) if bin(int(q[i]) ^ int(a[j])).count("1") <= 23}


def held(k, m):
    return k is not None and zlib.crc32(str(k).encode()) % m == 2


def test_ppm(docs, empty):
    from lakequery.llm.ppm import score_documents

    rows = texts(docs)
    count, trie = Counter(), defaultdict(Counter)
    for k, t in rows:
        if not held(k, 7):
            count.update(words(lower(t)) + [None])
            s = [257] * 4 + list(lower(t).encode()) + [256]
            for i in range(4, len(s)):
                for j in range(5):
                    trie[tuple(s[i - j : i])][s[i]] += 1
    n, v = sum(count.values()), len(count)

    def logp(s, i):
        gone, p = set(), 0.0
        for j in range(4, -1, -1):
            c = trie.get(tuple(s[i - j : i]))
            if not c:
                continue
            left = {a: x for a, x in c.items() if a not in gone}
            total = sum(left.values()) + len(left)
            if s[i] in left:
                return p + math.log10(left[s[i]] / total)
            p += math.log10(len(left) / total) if total else 0.0
            gone = set(c)
        return p - math.log10(max(1, 257 - len(gone)))

    expected = []
    for k, t in rows:
        tokens = words(lower(t)) + [None]
        s = [257] * 4 + list(lower(t).encode()) + [256]
        expected.append((k or 0, held(k, 7), len(tokens), sum(count[x] > 0 for x in tokens), n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in tokens), 4), round(sum(logp(s, i) for i in range(4, len(s))), 4)))
    for kw in ({}, {"part_strings": 500, "common": 40}):  # the second splits the trie and joins most words
        got = [(r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), round(r.score, 4)) for r in score_documents(docs, **kw).collect()]
        assert [x[:5] for x in sorted(got)] == [x[:5] for x in sorted(expected)]
        assert np.allclose([x[5:] for x in sorted(got)], [x[5:] for x in sorted(expected)], rtol=1e-9, atol=2e-4)
    assert score_documents(empty).count() == 0


def test_language(spark, docs, empty):
    from lakequery.llm.language_mixture import Mixture, identified, identify, trigrams

    sf = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = identify(sf).join(sf.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got) > 20
    got = identify(docs).collect()
    assert len(got) == docs.count() and all(r.held_out == held(r.doc_id, 4) and 0 <= r.score <= 1 for r in got)
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert und == {k for k, t in texts(docs) if not any(c.isalpha() for c in t or "")}
    assert identified(docs).columns == docs.columns and identified(docs).count() == docs.count() - sum(not any(c.isalpha() for c in t or "") for _, t in texts(docs))
    assert identify(empty).count() == 0
    assert {r.lang_pred for r in identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    a, b = b"aba bab aab " * 50, b"xyx yxy xxy " * 50
    counts = np.stack([np.bincount(trigrams(t), minlength=1 << 16) for t in (a, b)], axis=1)
    fit = dict(Mixture(["p", "q"], counts).fit(a + b))
    assert abs(fit["p"] - 0.5) < 0.05 and Mixture(["p", "q"], counts).fit(a)[0][0] == "p" and len(Mixture(["p", "q"], counts).fit(a)) == 1


def test_mixture_fit():
    """Expectation-maximisation over every trigram of a text in turn, and the choice among nested sets, in plain Python."""
    from lakequery.llm.language_mixture import Mixture, trigrams

    r = random.Random(6)
    langs = ["p", "q", "r"]
    alphabets = ("abcde ", "cdefg ", "klmno ")
    make = lambda a, n: "".join(r.choice(a) for _ in range(n)).encode()
    counts = np.stack([np.bincount(trigrams(make(a, 4000)), minlength=1 << 16) for a in alphabets], axis=1)
    model = Mixture(langs, counts, smoothing=0.5, penalty=2.0, rounds=12)
    size = 1 << 16
    prob = {f: [(counts[f, k] + 0.5) / (counts[:, k].sum() + 0.5 * size) for k in range(3)] for f in range(size) if counts[f].any()}
    unseen = [0.5 / (counts[:, k].sum() + 0.5 * size) for k in range(3)]

    def em(rows, chosen, theta):
        for _ in range(12 if len(chosen) > 1 else 0):
            new = [0.0] * len(chosen)
            for row in rows:
                of = [row[k] * t for k, t in zip(chosen, theta, strict=True)]
                new = [a + b / sum(of) for a, b in zip(new, of, strict=True)]
            theta = [x / len(rows) for x in new]
        # likelihoods over their mean in each bucket, as the penalty compares sums of logs
        return theta, sum(math.log(sum(row[k] * t for k, t in zip(chosen, theta, strict=True)) / (sum(row) / 3)) for row in rows)

    for text in (make(alphabets[0], 300), make(alphabets[0], 200) + make(alphabets[2], 100), make(alphabets[0], 150) + make(alphabets[1], 150), b"".join(make(a, 120) for a in alphabets), b"abc"):
        rows = [prob.get(int(f), unseen) for f in trigrams(text)]
        theta, _ = em(rows, range(3), [1 / 3] * 3)
        order = sorted(range(3), key=lambda k: (-theta[k], langs[k]))
        tried = []
        for n in range(1, 4):
            if n > 1 and theta[order[n - 1]] < 0.01:
                break
            chosen = order[:n]
            t, ll = em(rows, chosen, [theta[k] / sum(theta[j] for j in chosen) for k in chosen])
            tried.append((ll - 2.0 * n * math.log(len(rows) + 1), {langs[k]: x for k, x in zip(chosen, t, strict=True)}))
        want = max(tried, key=lambda x: x[0])[1]
        got = dict(model.fit(text))
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 2e-3 for k in want)
    assert len(model.fit(b"x" * 5_000_000)) >= 1  # a very long text costs no more than its distinct trigrams


def test_language_rejects(spark):
    """The fitted mixture rejects a text that no language holds half of; without a model, all with a letter stay."""
    from lakequery.llm.language_mixture import identified

    langs = {"p": "aba bab aab ", "q": "xyx yxy xxy ", "r": "mnm nmn mmn "}
    ids = [i for i in range(200) if not held(i, 4)][:30]
    made = [(k, langs["pqr"[i % 3]] * 40, "pqr"[i % 3]) for i, k in enumerate(ids)]
    made += [(1000, "".join(x * 40 for x in langs.values()), None), (1001, langs["p"] * 90 + langs["q"] * 30, None), (1002, "12 34 ...", None), (1003, None, None)]
    df = spark.createDataFrame(made, "doc_id long, text string, lang string")
    assert {x.doc_id for x in identified(df).collect()} == {*ids, 1001}
    assert {x.doc_id for x in identified(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {*ids, 1000, 1001}


def fill(sizes, share=1.5):
    """Iterative sharing of the targets."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        level = (total - sum(target.values())) / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > 2 * sizes[s]}
        if not over:
            return target | {s: level * w[s] for s in open_}
        target |= {s: 2 * sizes[s] for s in over}
        open_ -= over
    return target


def test_mix(docs, empty):
    from lakequery.llm.source_mix import mix_sources

    rows = mix_sources(docs).collect()
    assert len(rows) == docs.count()
    sizes = Counter()
    for r in rows:
        assert r["size"] == len(words(r.text)) and r.taken in (0, r["size"], 2 * r["size"])
        sizes[r.source] += r["size"]
    target = fill(sizes)
    for s in sizes:
        mine = [r for r in rows if r.source == s]
        assert all(abs(r.target - target[s]) < 1e-6 and r.source_size == sizes[s] for r in mine)
        assert abs(sum(r.taken for r in mine) - target[s]) <= max(r["size"] for r in mine)
    assert sorted((r.doc_id or 0, r.taken) for r in rows) == sorted((r.doc_id or 0, r.taken) for r in mix_sources(docs.repartition(5)).collect())
    clash = mix_sources(docs.select("*", *(F.lit(7).alias(c) for c in ("row", "_b", "__B", "n", "key", "_m_s", "taken")))).collect()
    assert {(r.row, r["_b"], r["__B"], r.n, r.key, r["_m_s"]) for r in clash} == {(7,) * 6} and sorted((r.doc_id or 0, r.taken) for r in clash) == sorted((r.doc_id or 0, r.taken) for r in rows)
    assert mix_sources(empty).count() == 0
    nothing = docs.withColumn("text", F.lit(None).cast("string"))
    assert {r.taken for r in mix_sources(nothing).collect()} == {0}


def test_quality(spark, docs, empty):
    from lakequery.llm.mcd_quality import chi2_cdf, judge, statistics

    ts = [t or "" for _, t in texts(docs)]
    s = statistics([t.encode() for t in ts])
    for i, t in enumerate(ts):
        w = words(t)
        c = Counter(tuple(w[j : j + 3]) for j in range(len(w) - 2))
        cover = {j + d for j in range(len(w) - 2) if c[tuple(w[j : j + 3])] > 1 for d in range(3)}
        lines = [x for x in t.split("\n") if words(x)]
        assert (s["n_words"][i], s["word_chars"][i], s["n_symbols"][i], s["n_dup_lines"][i], s["n_repeat_words"][i]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))
    got = judge(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    assert judge(empty).count() == 0
    assert abs(chi2_cdf(9.487729, 4) - 0.95) < 1e-6
    clean = docs.where("text is not null").select((F.col("doc_id") + 10000).alias("doc_id"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.expr("array_join(transform(sequence(1, 80), i -> substr(md5(concat(doc_id, '/', i)), 1, 3 + i % 4)), ' ')").alias("text"))
    junk = clean.limit(3).select("doc_id", "lang", "source", F.replace("text", F.lit(" "), F.lit("*** ")).alias("text")).withColumn("doc_id", F.col("doc_id") + 10000)
    kept = {r.doc_id: r.kept for r in judge(clean.union(junk).where("doc_id is not null")).collect()}
    assert not any(v for k, v in kept.items() if k >= 20000) and all(v for k, v in kept.items() if k < 20000)


def test_quality_alone(spark):
    """Each statistic rejects by itself, and small deviations do not."""
    from lakequery.llm.mcd_quality import judge

    r = random.Random(8)
    word = lambda n=5: "".join(r.choice("abcdefghijklmnop") for _ in range(n))
    plain = lambda n: [word(r.randint(3, 7)) for _ in range(n)]
    made = [(i, "\n".join(" ".join(plain(10)) for _ in range(10))) for i in range(200)]
    phrase = plain(15)
    made += [
        (1000, " ".join(word(11) for _ in range(100))),
        (1001, " ".join(word(2) for _ in range(100))),
        (1002, " ".join(w + "#" * (i % 5 == 0) for i, w in enumerate(plain(100)))),
        (1003, "\n".join("same" if i % 2 else w for i, w in enumerate(plain(100)))),
        (1004, " ".join(plain(35) + phrase + plain(35) + phrase)),
        (2000, " ".join(plain(97) + phrase[:3] + plain(97) + phrase[:3])),
        (2001, "\n".join(["same", *plain(48), "same"])),
        (2002, " ".join(plain(50) + ["#" + word()] + plain(50))),
    ]
    got = {x.doc_id: x for x in judge(spark.createDataFrame([(k, "en", "s", t) for k, t in made], "doc_id long, lang string, source string, text string")).collect()}
    assert not any(x.base_failed for x in got.values())
    rates = {k: (got[k].n_symbols > 0, got[k].n_dup_lines > 0, got[k].n_repeat_words > 0) for k in range(1000, 1005)}
    assert rates == {1000: (False,) * 3, 1001: (False,) * 3, 1002: (True, False, False), 1003: (False, True, False), 1004: (False, False, True)}
    assert {k for k, x in got.items() if not x.kept} == set(range(1000, 1005))


def brute_mcd(xs):
    """The estimate of one group by its definition, in numpy over all rows: (mean, covariance, determinant in units of the floors)."""
    from lakequery.llm import mcd_quality as m

    x, floors = np.array(xs, dtype=float), np.array(m.FLOORS)
    n = len(x)

    def median(v):
        return np.array([(sorted(math.floor(a * 256) for a in col)[(n + 1) // 2 - 1] + 0.5) / 256 for col in v.T])

    def floored(cov):
        var, axes = np.linalg.eigh(cov / np.outer(floors, floors))
        var = np.maximum(var, 1)
        return np.linalg.inv(axes @ np.diag(var) @ axes.T * np.outer(floors, floors)), np.prod(var)

    mid = median(x)
    scale = np.maximum(median(abs(x - mid)) * 1.4826, floors)
    z = (x - mid) / scale
    u = z / np.sqrt(np.maximum((z**2).sum(axis=1, keepdims=True), 1e-12))
    best = None
    for mean, cov in ((mid, np.diag(scale**2)), (x.mean(axis=0), np.cov(x.T, bias=True)), (mid, u.T @ u / n * 4 * np.outer(scale, scale))):
        det = math.inf
        while True:
            inverse, _ = floored(cov)
            bins = np.array([math.floor(math.log2((r - mean) @ inverse @ (r - mean) + 1 / 64) * 32) for r in x])
            cut = next(b for b in sorted(set(bins)) if (bins <= b).sum() >= 0.75 * n)
            near = x[bins <= cut]
            new_mean, new_cov = near.mean(axis=0), np.cov(near.T, bias=True).reshape(4, 4) * m.SHRINK
            new = floored(new_cov)[1]
            if not new < det * 0.99:
                break
            mean, cov, det = new_mean, new_cov, new
        if best is None or det < best[2]:
            best = (mean, cov, det)
    return best


def test_quality_estimates(spark):
    """Against the definition in numpy, against all subsets of a small group, and alike however rows are dealt."""
    from itertools import combinations

    from lakequery.llm import mcd_quality as m

    r = np.random.default_rng(5)
    scatter = np.array([[0.3, 0.2, 0, 0], [0, 0.5, 0.3, 0], [0, 0, 1.2, 0.4], [0, 0, 0, 1.1]])
    groups = {"a": np.abs(r.normal(size=(120, 4)) @ scatter + [1.8, 2, 3, 2]), "b": np.abs(r.normal(size=(14, 4)) @ scatter * 2 + [1.8, 2, 3, 2]), "c": np.full((9, 4), 1.5), "d": np.array([[1.0, 2.0, 0.5, 0.25]])}
    groups["a"][:25] += [2, 4, -1, 3]
    rows = [(g, list(map(float, v))) for g, x in groups.items() for v in x]
    df = spark.createDataFrame(rows, "g string, x array<double>")
    got = {e.g: e for e in m.estimates(df.repartition(7)).collect()}
    again = {e.g: e for e in m.estimates(df.coalesce(1)).collect()}
    for g, x in groups.items():
        mean, cov, det = brute_mcd(x)
        for e in (got[g], again[g]):
            assert e.rows == len(x) and np.allclose(e.mean, mean, atol=1e-9) and np.allclose(e.cov, cov.ravel(), atol=1e-9) and math.isclose(e.det, det, rel_tol=1e-9)
    least = min(m._floored(np.cov(groups["b"][list(c)].T, bias=True) * m.SHRINK)[1] for c in combinations(range(14), 11))
    assert got["b"].det <= 1.3 * least
    clean = np.linalg.det(np.cov(groups["a"][25:].T))
    assert np.linalg.det(np.array(got["a"].cov).reshape(4, 4)) < 4 * clean < np.linalg.det(np.cov(groups["a"].T))


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, v):
    d = re.sub("[^0-9]", "", v)
    luhn = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in v.split(".")), "card": 14 <= len(d) <= 19 and luhn, "phone": 10 <= len(d) <= 15}[kind]


def test_personal_data(spark, docs, empty):
    from lakequery.llm.disclosure import sanitise

    odd = ["a@b.co.x%y@z.com a.b@c..d x@y.z. q@w.e_r +1 (202) 555-0147", "4111 1111 1111 1111 300.1.1.1 1.2.3.4.5.6.7.8", "é" * 50 + " 😀 user@host.org 4111-1111-1111-1111 10.0.0.1\n+44 20 7946 0958 x", "a@b@c.de", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 " * 300, "+1" + "(" * 3000, "a" * 20000, "a.b@c.d " * 300, "00000000000000000000001.2.3.4", "@ab x@yz"]
    told = [f"report {i} by Zanzibar mail zed@corp.example for all" for i in range(6)] + [f"some plain line number {i} with common words report" for i in range(2000)]
    made = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(odd + told)], "doc_id long, text string")
    both = docs.select("doc_id", "text").union(made)
    got = sanitise(both).collect()
    assert len(got) == both.count()
    have = {k: t for k, t in texts(both) if k is not None}
    for r in got:
        if r.doc_id is None:
            continue
        t = have[r.doc_id] or ""
        spans = sorted((m.start(), rank, m.end(), k) for rank, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, t) if valid(k, m.group()))
        c = Counter(k for *_, k in spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(c[k] for k in PATTERNS), t[:80]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{e}" for a, _, e, k in spans).encode()).hexdigest()
    named = [r for r in got if r.n_term]
    assert len(named) == 6 and all("Zanzibar" not in r.sanitised and "[EMAIL]" in r.sanitised for r in named)
    assert sanitise(empty).count() == 0


def test_disclosing_terms(spark):
    """Two documents, short names and names with digits, whatever the number of documents; words beyond the context's edge are whole."""
    from lakequery.llm.disclosure import sanitise

    for n in (40, 1200):
        plain = [f"a plain line of common words at home, for all and it is mail {i % 7}" for i in range(n)]
        told = [f"{i} common words for Ann k9x at ann@corp.example and all" for i in range(2)]
        often = ["it is Bo +1 202 555 0147"] * (n // 20)
        edges = ["mail q@edge.example Cleo"] * 2 + ["a " * 60 + "Whole" + " " * 59 + "z@far.example", "a " * 60 + "Whole " + " " * 58 + "z@far.example"] + ["Partly" + " " * 59 + "y@cut.example", "a Partly" + " " * 59 + "y@cut.example"]
        made = [*plain, *told, *often, *edges]
        got = [r.sanitised for r in sorted(sanitise(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")).collect(), key=lambda r: r.doc_id)]
        assert got[:n] == plain
        assert got[n : n + 2] == [f"{i} common words for [NAME] [CODE] at [EMAIL] and all" for i in range(2)]
        assert {x.replace("[NAME]", "") for x in got[n + 2 : n + 2 + len(often)]} in ({"it is  [PHONE]"}, {"it is   [PHONE]"})
        assert got[-6:-4] == ["mail [EMAIL] [NAME]"] * 2 and not any("Whole" in x for x in got) and all("Partly" in x for x in got[-2:])


def test_secrets(spark):
    from lakequery.llm.disclosure import sanitise

    key = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    made = [f'text token = "{key}" end', "a_long_name_without_digits_at_all", "x" * 30 + "1234", "1" * 40, f"mail {key[:20]}@host.example", "aaaaaaaaaaaaaaaaaaaa1111", key[:19], None]
    got = [(r.n_secret, r.n_private, r.sanitised) for r in sorted(sanitise(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")).collect(), key=lambda r: r.doc_id)]
    assert got == [(1, 1, 'text token = "[SECRET]" end')] + [(0, 0, t) for t in made[1:4]] + [(0, 1, "mail [EMAIL]")] + [(0, 0, t) for t in made[5:]]


def test_disclosure_statistic(spark):
    """Counts, certainties and bits of all terms against plain Python."""
    import regex

    from lakequery.llm import disclosure as m

    r = random.Random(12)
    vocabulary = [f"w{i}" if i % 5 == 0 else "".join(r.choice("abcdefg") for _ in range(r.randint(1, 7))) for i in range(60)]
    people = [(f"Per{c}", f"{c}@x{i}.example") for i, c in enumerate("abcdefgh")]
    made = []
    for i in range(300):
        w = [r.choice(vocabulary) for _ in range(r.randint(1, 40))]
        if r.random() < 0.3:
            name, mail = r.choice(people)
            w[r.randrange(len(w) + 1) : 0] = [name, mail] if r.random() < 0.7 else [mail]
        made.append((i, " ".join(w) + r.choice(["", "", "\n"])))
    made += [(made[0][0], made[0][1]), (None, None), (400, "")]
    term = lambda t: set(regex.findall(r"[\p{L}\p{N}]+", t.lower()))
    n_t, n_e, n_te, total = Counter(), Counter(), Counter(), len(made)
    for _, t in made:
        t = t or ""
        n_t.update(term(t))
        pairs, ents = set(), set()
        for x in re.finditer(PATTERNS["email"], t):
            left, right = t[max(0, x.start() - 65) : x.start()], t[x.end() : x.end() + 65]
            if len(left) > 64:
                left = regex.sub(r"^[\p{L}\p{N}]+", "", left)
            if len(right) > 64:
                right = regex.sub(r"[\p{L}\p{N}]+$", "", right)
            ents.add(x.group())
            pairs |= {(x.group(), w) for w in term(left) | term(right)}
        n_e.update(ents)
        n_te.update(pairs)
    want = {}
    for (e, w), k in n_te.items():
        k = min(k, n_t[w])
        certainty = (total * k - n_e[e] * n_t[w]) / ((n_t[w] + 2) * (total - n_e[e]))
        if certainty >= 0.5:
            bits = math.log2(total * k / (n_t[w] * n_e[e]))
            old = want.get(w, (-math.inf, -math.inf))
            want[w] = (max(old[0], bits), max(old[1], certainty))
    df = spark.createDataFrame(made, "doc_id long, text string")
    found = m.find_entities(df).where(F.size("_x_spans") > 0)
    got = {x.term: (x.bits, x.certainty, x.remove) for x in m.disclosing_terms(df, found).collect()}
    assert set(got) == set(want) and len(want) >= 5
    for w, (bits, certainty) in want.items():
        assert math.isclose(got[w][0], bits, rel_tol=1e-9) and math.isclose(got[w][1], certainty, rel_tol=1e-9) and got[w][2] == (certainty >= 0.9)


def test_tokens(spark, docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    from lakequery.llm.pfor_tokens import decode_blocks, encode_blocks, read_tokens, write_tokens

    r = np.random.default_rng(0)
    for a in (np.zeros(0, np.uint32), np.array([7], np.uint32), r.integers(0, 2**32, 1000).astype(np.uint32), r.zipf(1.3, 5000).clip(0, 50000).astype(np.uint32), np.full(128, 9, np.uint32)):
        assert (decode_blocks(encode_blocks(a)) == a).all()
    with pytest.raises(ValueError):
        decode_blocks(b"\0" * 12)
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    t = Tokenizer.from_file(path)
    assert t.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    odd = ["a <|endoftext|> b", "\ue000a b \ue000c", "b \ue000", "a b ", "a\u2003 b \u00a0c", "a\n\nb c\n", " a  b\n c", "it's  he'll 'tis 's", "x\x1c y", "<|endoftext|> a <|endoftext|>", "a \n\n b\t \tc ", " lead trail ", "a\x00b \x00c", "\x00x", "a  b 　c"]
    made = docs.select("doc_id", "text").where("doc_id is not null").dropDuplicates(["doc_id"]).union(spark.createDataFrame([(10**6 + i, x) for i, x in enumerate(odd)], "doc_id long, text string"))
    got = [tuple(x) for x in read_tokens(write_tokens(made, path)).collect()]
    expected, start = [], 0
    for k, x in sorted(texts(made)):
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        expected.append((k, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert sorted(got) == expected
    from lakequery.llm.pfor_tokens import Pieces

    pieces, q = Pieces(path), random.Random(1)
    signs = [" ", "\n", ".", ",", "!", "a", "B", "é", "1", "²", "'", "s", "\t", "\u00a0", "-", "(", "中", "\r", "\x1c", "\u2003", "\u0301", "_", "ª", "'ll", "\ue001", "<|endoftext|>"]
    strange = ["".join(q.choice(signs) for _ in range(q.randint(0, 30))) for _ in range(4000)]
    ids, sizes = pieces.encode(pa.array(strange))
    at = np.concatenate([[0], np.cumsum(sizes)])
    assert all(ids[at[i] : at[i + 1]].tolist() == t.encode(x, add_special_tokens=False).ids + [0] for i, x in enumerate(strange))
    whole = read_tokens(write_tokens(docs, path)).collect()
    assert len(whole) == docs.count() and sorted((x.start for x in whole)) == sorted(np.cumsum([0] + [x.n_tokens for x in sorted(whole, key=lambda x: x.start)])[:-1].tolist())
    assert read_tokens(write_tokens(empty, path)).count() == 0


def test_pipeline_odd(spark, docs, empty):
    """Nulls, repeated rows, clashing names and an empty table pass every stage; columns of the input keep their values."""
    import corpus_pipeline

    kept = docs.withColumns({c: F.lit(7) for c in ("row", "taken", "target", "source_size", "_rid", "group", "slot")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, "/root/testdata/sf0.001").persist()
        assert after.columns == kept.columns, name
        assert {tuple(r) for r in after.select("row", "taken", "target", "source_size", "_rid", "group", "slot", "k", "rid", "size", "shard").collect()} == {(7, 7, 7, 7, 7, 7, 7, 9, "clash", 3, "x")}, name
        assert stage(spark, empty, "/root/testdata/sf0.001").count() == 0, name
        kept = after
    out = corpus_pipeline.STAGES[-1][1](spark, kept, "")
    assert out.count() == kept.count() > 20 and corpus_pipeline.STAGES[-1][1](spark, empty, "").count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, "/root/testdata/sf0.001").persist()
        assert after.columns == docs.columns, name
        if name != "mix":
            assert after.count() == after.select("doc_id").distinct().count() and after.join(kept, "doc_id", "left_anti").isEmpty()
        kept = after
    sets = sets_of(texts(kept))
    for a in sets:
        for b in sets:
            assert a >= b or not sets[a] or 100 * len(sets[a] & sets[b]) < 80 * len(sets[a] | sets[b])
    assert corpus_pipeline.STAGES[-1][1](spark, kept, "").count() == kept.count()


def test_sql(spark):
    import duckdb

    from lakequery.llm import queries

    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    for name, sql in queries.oracle_sql().items():
        df = queries.queries()[name](spark, "/root/testdata/sf0.001")
        r = con.sql(sql)
        at = [list(r.columns).index(c) for c in df.columns]
        assert sorted(map(tuple, df.collect())) == sorted(tuple(x[i] for i in at) for x in r.fetchall()), name
