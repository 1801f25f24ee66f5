"""N-gram join, Merkle manifest and filter audit against brute force, with nulls, empty and long
texts, ties, repeated rows, empty tables and extra columns with clashing names."""

import hashlib
import random
import re
import zlib
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from quarry.llm import filter_audit, merkle, ngram_join
from quarry.llm.common import ship

DOCS = "doc_id long, text string"
WIDE = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def slow_words(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())


# 11 n-gram join ------------------------------------------------------------

def slow_set(text, k=5):
    w = [x.lower() for x in slow_words(text)]
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def slow_classes(rows, percent=80):
    """(id, size, component) of each row, by comparing all with all."""
    sets = [slow_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(root(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        known = [x for x in least[root(i)] if x is not None]
        out.append((d, len(sets[i]), min(known) if known else None))
    return sorted(out, key=repr)


def edited(rng, words, share):
    return [f"e{rng.randrange(10 ** 6)}" if rng.random() < share else w for w in words]


def corpus(seed, groups=12, size=9):
    """Groups of near copies at all distances, and passages that many texts share."""
    rng = random.Random(seed)
    shared = [f"s{i}" for i in range(60)]
    texts = []
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(300)}" for _ in range(rng.choice([6, 30, 120, 250]))]
        for _ in range(size):
            words = edited(rng, base, rng.choice([0, 0.004, 0.01, 0.02, 0.03, 0.05]))
            if rng.random() < 0.3:
                words = words + shared
            texts.append(" ".join(words) if rng.random() < 0.5 else "\n".join(words).upper())
    texts += [None, "", "  \n", "a", "A", "a b", "a  b", "a b c d e", "a b c d e f", "x " * 50_000, "x " * 40_000, " ".join(shared)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(None, texts[0]), (None, None), (3, texts[13]), (3, texts[3]), (5, texts[16]), (None, "only without an id")]
    rng.shuffle(rows)
    return rows


def found_classes(df, **options):
    return sorted([tuple(r) for r in ngram_join.similarity_classes(df, **options).collect()], key=repr)


def test_ngram_join_equals_brute_force(spark):
    rows = corpus(1)
    assert found_classes(spark.createDataFrame(rows, DOCS)) == slow_classes(rows)


@pytest.mark.parametrize("short, run, block", [(2, 4, 3), (2, 1 << 15, 5)])
def test_long_and_dealt_tiles_lose_no_link(spark, monkeypatch, short, run, block):
    monkeypatch.setattr(ngram_join, "_SHORT", short)
    monkeypatch.setattr(ngram_join, "_BLOCK", block)
    monkeypatch.setattr(ngram_join, "RUN", run)
    rows = corpus(2, groups=5, size=14)
    assert found_classes(spark.createDataFrame(rows, DOCS), run=run) == slow_classes(rows)


def test_bitmaps_bound_the_overlap_from_above():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(1, 400)
        a = ngram_join.gram_sets([" ".join(f"w{rng.randrange(500)}" for _ in range(n)).encode()])[0]
        b = ngram_join.gram_sets([" ".join(f"w{rng.randrange(500)}" for _ in range(n)).encode()])[0]
        b = ngram_join.np.unique(ngram_join.np.concatenate([a[:rng.randrange(len(a) + 1)], b[:rng.randrange(len(b) + 1)]])) if n > 9 else b
        if not len(b):
            continue
        words = min(len(ngram_join.bitmap(a)), len(ngram_join.bitmap(b))) // 8
        x, y = (ngram_join._folded([ngram_join.bitmap(s)], words) for s in (a, b))
        n, m = (ngram_join.np.array([len(s)]) for s in (a, b))
        assert ngram_join._most(x, y, n, m)[0] >= len(set(a.tolist()) & set(b.tolist()))


def test_ngram_join_of_other_columns_and_no_rows(spark):
    rows = corpus(4, groups=2)
    wide = "id long, body string, sid string, n string, digest string, gram int, comp int, text string, doc_id string"
    df = spark.createDataFrame([(d, t, *[None] * 7) for d, t in rows], wide)
    assert found_classes(df, id_col="id", text_col="body") == slow_classes(rows)
    assert found_classes(spark.createDataFrame([], DOCS)) == []
    assert found_classes(spark.createDataFrame([(1, None), (2, "")], DOCS)) == [(1, 0, 1), (2, 0, 2)]


# 12 Merkle manifest --------------------------------------------------------

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def cell(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def slow_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def slow_path(levels, i):
    """(sibling, whether it is left) level by level; None where a node is alone."""
    out = []
    for level in levels[:-1]:
        out.append((level[i ^ 1], i % 2 == 1) if i ^ 1 < len(level) else None)
        i //= 2
    return out


def slow_manifest(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    def leaf(d, text, lang, source, n):
        return h(*[cell(v) for v in (d, source, lang, n, text)])
    parts = {}
    for r in rows:
        parts.setdefault(r[2], []).append(r)
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {}
    for p in names:
        parts[p].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[p] = slow_levels([leaf(*r) for r in parts[p]])
    top = slow_levels([trees[p][-1][0] for p in names])
    out = []
    for k, p in enumerate(names):
        for i, r in enumerate(parts[p]):
            path = slow_path(trees[p], i) + slow_path(top, k)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            now = leaf(*r[:4], r[4] + 1) if bad else leaf(*r)
            for step in path:
                now = h(now) if step is None else h(step[0], now) if step[1] else h(now, step[0])
            out.append((r[0], leaf(*r), trees[p][-1][0], top[-1][0], h(*[s[0] for s in path if s]), now, now == top[-1][0]))
    return sorted(out, key=repr)


def found_manifest(df, **options):
    more = (df["n_chars"].cast("decimal(20,0)") + 1).cast("string")
    got = merkle.manifest(df, altered=F.crc32(df["doc_id"].cast("string")) % 7 == 0, presented={"n_chars": more}, **options)
    return sorted([tuple(r) for r in got.collect()], key=repr)


def manifest_rows():
    rng = random.Random(5)
    rows = [(i, rng.choice([None, "", f"text {i} é", "x" * 9000]), rng.choice(["de", "en", "en", "en", None, "", "日本", f"l{i % 23}"]),
             rng.choice([None, "", "s1"]), rng.choice([None, 0, i, 2 ** 63 - 1])) for i in range(300)]
    return rows + [rows[5], rows[5], rows[17], (None, "a", "en", "s", 1), (None, "b", "en", "s", 1), (None, None, None, None, None),
                   (17, "other", rows[17][2], "s", 3)]


@pytest.mark.parametrize("levels", [1, 3, 10])
def test_manifest_equals_brute_force(spark, levels):
    rows = manifest_rows()
    assert found_manifest(spark.createDataFrame(rows, WIDE), block_levels=levels) == slow_manifest(rows)


@pytest.mark.parametrize("count", [0, 1, 2, 3, 5])
def test_small_manifests(spark, count):
    rows = [(i, "t", "en", "s", 1) for i in range(count)]
    assert found_manifest(spark.createDataFrame(rows, WIDE), block_levels=1) == slow_manifest(rows)


def test_manifest_of_clashing_columns(spark):
    rows = manifest_rows()[:40]
    df = spark.createDataFrame([(*r, "x", 1, None) for r in rows], WIDE + ", id string, uid int, tree string")
    assert found_manifest(df, block_levels=2) == slow_manifest(rows)


def test_a_changed_text_changes_its_roots_only(spark):
    rows = [(i, f"t{i}", "en" if i % 2 else "de", "s", 1) for i in range(20)]
    one = {r[0]: r for r in found_manifest(spark.createDataFrame(rows, WIDE), block_levels=2)}
    rows[4] = (4, "changed", "de", "s", 1)
    two = {r[0]: r for r in found_manifest(spark.createDataFrame(rows, WIDE), block_levels=2)}
    assert one[4][1] != two[4][1] and one[6][1] == two[6][1]
    assert one[6][2] != two[6][2] and one[5][2] == two[5][2] and one[5][3] != two[5][3]


# 13 filter audit -----------------------------------------------------------

def slow_fails(rows):
    """The set of filters that each row fails."""
    out = []
    for d, t, *_ in rows:
        t = t or ""
        w = slow_words(t)
        bad = set()
        if len(w) < 200:
            bad.add("A")
        if 100 * len(set(w)) < 50 * len(w):
            bad.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t):
            bad.add("C")
        if re.search("[#$%&*|]", t):
            bad.add("D")
        if d is not None and any(e is not None and e < d and (u or "") == t for e, u, *_ in rows):
            bad.add("E")
        out.append(bad)
    return out


def slow_audit(rows, labels):
    fails = slow_fails(rows)
    good, toxic = ({d for d, *v in labels if d is not None and v[k] == 1} for k in (0, 1))
    out = []
    for part in {r[2] or "" for r in rows}:
        own = [(r[0], f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        removed, lines = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = own
            for k, x in enumerate(order, 1):
                gone = [(d, f) for d, f in left if x in f]
                left = [(d, f) for d, f in left if x not in f]
                removed[x] += len(gone)
                lines.append((part, "".join(order), k, x, len(left), len(gone), sum(x in f for _, f in own) - len(gone),
                              sum(f == {x} for _, f in own), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)))
        out += [(*line[:3], *line[4:], removed[line[3]]) for line in lines]
    return sorted(out)


def audit_rows(seed, count=120):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        n = rng.choice([0, 3, 150, 199, 200, 260])
        words = [rng.choice(["aa", "bb"]) if rng.random() < rng.choice([0, 0.6]) else f"w{rng.randrange(999)}" for _ in range(n)]
        text = " ".join(words)
        if rng.random() < 0.3:
            text = text.upper()
        if rng.random() < 0.3:
            text += rng.choice(["#", " |", "é%", "ÄÖ"])
        rows.append((i, text if rng.random() < 0.95 else None, rng.choice(["en", "de", "", None])))
    rows += [(200 + i, rows[rng.randrange(count)][1], rng.choice(["en", "de", None])) for i in range(60)]
    rows += [rows[0], rows[0], (7, rows[9][1], "en"), (None, rows[1][1], "en"), (None, None, None), (300, "word " * 60_000, "en")]
    labels = [(rng.randrange(260), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(150)] + [(None, 1, 1)]
    return rows, labels


def found_audit(spark, rows, labels, more=""):
    docs = spark.createDataFrame([(*r, *[None] * more.count(",")) for r in rows], "doc_id long, text string, lang string" + more)
    return sorted(tuple(r) for r in filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect())


def test_audit_equals_all_orders(spark):
    rows, labels = audit_rows(7)
    assert found_audit(spark, rows, labels) == slow_audit(rows, labels)


def test_audit_of_clashing_columns_and_no_rows(spark):
    rows, labels = audit_rows(8, 20)
    assert found_audit(spark, rows, labels, ", part int, mask int, digest string, first int, good int") == slow_audit(rows, labels)
    assert found_audit(spark, [], labels) == [] and found_audit(spark, rows, []) == slow_audit(rows, [])


def test_potentials_are_those_of_any_game(spark):
    """Against the mean of the marginal removals over all orders, for a game that is no coverage game."""
    rng = random.Random(9)
    v = [0] + [rng.randrange(1000) for _ in range(31)]
    games = spark.createDataFrame([("p", 1000, v, v, v)], "part string, n long, v array<long>, g array<long>, t array<long>")
    p = filter_audit.with_potentials(games).first()["p"]
    for i in range(5):
        total = 0
        for order in permutations(range(5)):
            before = sum(1 << j for j in order[:order.index(i)])
            total += v[before | 1 << i] - v[before]
        assert p[31] - p[31 ^ (1 << i)] == total
