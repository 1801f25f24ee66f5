"""The ten operators against brute force, exact round trips and held-out accuracy,
with nulls, empty and very long texts, ties, repeated rows, empty tables and
extra columns with clashing names."""

import hashlib
import html
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import (decontaminate, exact_dedup, html_wrapper, line_dedup, packing, pii, quality, queries, simhash,
                        token_files, url_filter)
from quarry.llm.common import ship
from quarry.llm.tokens import Encoder, vocabulary

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"
RICH = "doc_id long, text string, _uid string, _fp string, _text string, _doc string, _cut string, fp int, line int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def docs_of(spark, rows, schema=DOCS):
    """Rows of (id, text); a wider schema fills the other columns with nulls."""
    wide = len(schema.split(","))
    return spark.createDataFrame([tuple(r) + (None,) * (wide - len(r)) for r in rows], schema)


@pytest.fixture(scope="module")
def texts(spark):
    return {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def words(n, seed, size=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(size)}" for _ in range(n)]


# 1 decontamination -------------------------------------------------------

def edit_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_myers_equals_the_table():
    rng = random.Random(1)
    for _ in range(150):
        item = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 120)))
        assert decontaminate.Myers(item).best(text)[0] == edit_distance(item, text)


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(2)
    items = [(i, " ".join(words(25, i)).capitalize() + ".") for i in range(6)] + [(6, None), (7, "..."), (8, "")]
    rows = [(0, None), (1, ""), (2, "x" * 300_000)]
    for d in range(3, 60):
        text = " ".join(words(30, 1000 + d))
        if d % 3:
            item = list(items[d % 6][1])
            for _ in range(rng.randint(0, 9)):  # edits below and above the budget
                at = rng.randrange(len(item))
                item[at:at + rng.randint(0, 1)] = rng.choice(["", "q", "zz"])
            text += "\n" + "".join(item).upper() + " " + " ".join(words(20, 2000 + d))
        rows.append((d, text))
    rows += [(None, items[0][1]), (3, rows[3][1])]
    got = decontaminate.contaminated(docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    found = sorted((r.doc_id if r.doc_id is not None else -1, r.item_id, r.distance) for r in got)
    want = []
    for d, text in rows:
        for i, item in items:
            item = decontaminate.normalise(item or "")
            if item and len(text or "") < 100_000:
                k = edit_distance(item, decontaminate.normalise(text or ""))
                if k <= decontaminate.budget(len(item), decontaminate.ERROR_RATE):
                    want.append((-1 if d is None else d, i, k))
    assert found == sorted(want) and len({w[2] for w in want}) > 2
    # blocks of items give the same
    blocks = decontaminate.contaminated(docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string"), block_chars=200)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.item_id, r.distance) for r in blocks.collect()) == found
    left = decontaminate.decontaminate(docs_of(spark, rows, RICH), spark.createDataFrame(items, "item_id long, text string"))
    assert left.columns == docs_of(spark, [], RICH).columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in left.collect()) == sorted(
        (d is None, d or 0) for d, _ in rows if (-1 if d is None else d) not in {f[0] for f in found})
    assert decontaminate.contaminated(docs_of(spark, []), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert decontaminate.contaminated(docs_of(spark, rows), spark.createDataFrame([], "item_id long, text string")).count() == 0


# 2 URL filter ------------------------------------------------------------

def judged(url, rules, default="allow"):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in rules if r.host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.text), len(r.host)), default=None)
    return host, path, best.text if best else None, best.verdict if best else default


def test_url_filter_equals_brute_force(spark):
    rng = random.Random(3)
    hosts = ["com", "example.com", "www.example.com", "a.www.example.com", "net", "x.net", "badexample.com", "example.com.net", "EXAMPLE.com"]
    urls = [None, "", "no scheme", "http://", "http:///en/", "http://com", "http://com/", "x://y://com/en/", "http://example.com:80/en/",
            "http://ex\nample.com/a\nb?c"]
    urls += [f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/en', '/en/', '/en/1', '/es/x', '/fr/#y', '/e?n/'])}" for _ in range(300)]
    rules = list(url_filter.RULES) + [url_filter.Rule("block", h, p) for h in hosts[:5] for p in ("/e", "/en/1", "")]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(None, urls[10]), (10, urls[10])], "page_id long, url string")
    for own, block in ((rules, 3), (rules, 1000), (list(url_filter.RULES), 1000)):
        got = url_filter.filter_urls(pages, own, block_rules=block).collect()
        assert len(got) == len(urls) + 2
        for r in got:
            assert (r.host, r.path, r.rule, r.verdict) == judged(r.url, own), r
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


# 3 personal data ---------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    def luhn(x):
        return sum(v - 9 * (v > 9) for i, c in enumerate(reversed(x)) for v in [int(c) * (1 + i % 2)]) % 10 == 0

    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                    "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]():
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii_base_equals_the_patterns(spark, texts):
    rng = random.Random(4)
    odd = [None, "", "a@b.c@d.e_x@y.z", "@a.b", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.1.1.1 000.0.0.00 1.2.3.4", "4111 1111-1111 1111",
           "4111111111111111 4111111111111112 41111111111111111111", "+1 (555) 010-9999 ++12345678 +1.2.3 +12345678901234567",
           "﷐a@b.c﷑ 😀 +49 30 1234567 x", "a" * 2000, "1" * 2000, "1 " * 1000, "a@" * 500, "x@a" + ".b" * 500,
           "1.1" * 300, "+1" * 3000, "😀" * 1000 + "a@b.cd"]
    odd += ["".join(rng.choice(["1", "4", "11", ".", " ", "-", "+", "a", "@", "(", ")", "é", "_", "%", "\n"]) for _ in range(60)) for _ in range(400)]
    rows = [(i, t) for i, t in enumerate(odd)] + [(None, "z@y.xx"), (2, "z@y.xx"), (2, "z@y.xx")]
    got = pii.pii_digest(pii.find_pii(docs_of(spark, rows, RICH))).collect()
    assert len(got) == len(rows)
    want = sorted((str(d), hashlib.sha256(",".join(base_spans(t)).encode()).hexdigest()) for d, t in rows)
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == want
    by_id = {r.doc_id: r for r in got if r.doc_id != 2}
    for d, t in rows:
        if d not in (2, None):
            base = base_spans(t)
            assert set(base) <= set(filter(None, by_id[d].spans.split(",")))
            assert [by_id[d][f"n_{k}"] for k in PATTERNS] == [sum(x.startswith(k) for x in base) for k in PATTERNS]
    assert pii.find_pii(docs_of(spark, [])).count() == 0


def test_pii_of_very_long_runs(spark):
    """Linear in the text, where the plain patterns would take its square."""
    rows = list(enumerate(["a" * 200_000, "1" * 200_000, "1 " * 100_000, "a@" * 50_000, "+1" * 100_000, "x@a" + ".b" * 50_000]))
    got = {r.doc_id: len(r.base) for r in pii.find_pii(docs_of(spark, rows)).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 1}


def test_pii_redaction(spark):
    rows = [(1, "mail a@b.cd or +1 555 010 9999!"), (2, "none"), (3, None), (4, "4111 1111 1111 1111")]
    docs = docs_of(spark, rows)
    out = {r.doc_id: r.text for r in pii.redact(docs, pii.find_pii(docs)).collect()}
    assert out == {1: "mail [PII] or [PII]!", 2: "none", 3: None, 4: "[PII]"}


# 4 SimHash ---------------------------------------------------------------

def slow_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if not w:
        return 0
    s = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def slow_components(values, radius):
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def test_simhash_equals_brute_force(spark, texts):
    rows = sorted(texts.items()) + [(10_000, None), (10_001, ""), (10_002, "  \n"), (10_003, "One"), (10_004, "one  "),
                                    (10_005, "a b"), (10_006, "A\tB"), (10_007, "É é"), (10_008, "w " * 200_000)]
    got = {r.doc_id: r for r in simhash.simhash_groups(docs_of(spark, rows)).collect()}
    prints = [slow_fingerprint(t) for _, t in rows]
    roots = slow_components(prints, 2)
    for (d, _), p, r in zip(rows, prints, roots):
        assert got[d].fp & (1 << 64) - 1 == p and got[d].component_id == rows[r][0]
    null = simhash.simhash_groups(docs_of(spark, [(None, "x"), (5, "x"), (5, "x"), (None, "y")])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in null) == [(0, 0), (0, 5), (5, 5), (5, 5)]


def test_links_join_what_all_pairs_join(spark):
    rng = random.Random(5)
    values = []
    for _ in range(40):  # chains of one to two bits, and values near block limits
        v = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            values.append(v)
            for _ in range(rng.randint(1, 3)):
                v ^= 1 << rng.randrange(64)
    values = sorted(set(values))
    frame = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    found = {r.fp & (1 << 64) - 1: r.root for r in simhash.fingerprint_components(frame, "fp").collect()}
    roots = slow_components(values, 2)
    groups = {}
    for v, r in zip(values, roots):
        groups.setdefault(r, set()).add(found.get(v, simhash._signed(v)))
    assert all(len(g) == 1 for g in groups.values()) and len({x for g in groups.values() for x in g}) == len(groups)


def test_near_dedup_keeps_one_of_each_group(spark):
    long = " ".join(words(400, 6))
    rows = [(5, "x y z"), (3, "X y  z"), (3, "x y z"), (None, "x y z"), (9, long), (8, long + " w1"), (None, "alone here now"),
            (1, None), (2, "")]
    left = simhash.near_dedup(docs_of(spark, rows, RICH))
    assert left.columns == docs_of(spark, [], RICH).columns
    ids = sorted(str(r.doc_id) for r in left.collect())
    near = (slow_fingerprint(long) ^ slow_fingerprint(long + " w1")).bit_count() <= 2
    assert ids == sorted(["3", "None", "1"] + (["8"] if near else ["8", "9"]))
    assert simhash.near_dedup(docs_of(spark, [])).count() == 0


# 5 line dedup ------------------------------------------------------------

def slow_removed(rows, threshold=0.8):
    lines = [(d, i, frozenset(x.encode().lower().split())) for d, t in sorted(rows) for i, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    out = set()
    for n, (d, i, s) in enumerate(lines):
        for _, _, o in lines[:n]:
            if len(s & o) >= threshold * len(s | o) - 1e-9:
                out.add((d, i))
                break
    return out


def line_rows(seed, n=120):
    rng = random.Random(seed)
    base = [words(rng.choice([1, 2, 3, 4, 5, 6, 10, 20, 40, 150]), rng.random(), 150) for _ in range(30)]
    rows = []
    for d in range(n):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                line[rng.randrange(len(line))] = f"w{rng.randrange(150)}"
            lines.append(" ".join(line).upper() if rng.random() < 0.2 else " ".join(line))
        rows.append((d, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed,nearest", [(1, 2), (2, 1), (3, 1)])
def test_line_dedup_equals_brute_force(spark, seed, nearest):
    rows = line_rows(seed)
    slim = docs_of(spark, rows).select(F.col("doc_id").alias("doc"), "text")
    got = [(r.doc, r.line) for r in line_dedup.later_matches(slim, nearest=nearest).collect()]
    assert len(got) == len(set(got)) and set(got) == slow_removed(rows)


def test_line_dedup_on_the_given_texts(spark, texts):
    rows = sorted(texts.items())
    report = {r.doc_id: r for r in line_dedup.line_report(docs_of(spark, rows)).collect()}
    want = slow_removed(rows)
    got = {(d, int(x)) for d, r in report.items() for x in r.removed.split(",") if x}
    assert got == want and all(report[d].n_lines == t.count("\n") + 1 for d, t in rows)


def words_of_one_key():
    """Two words that share the 32 bits of the index."""
    many = [b"%d" % i for i in range(400_000)]
    size = np.array([len(w) for w in many])
    h = line_dedup._hashes(b" ".join(many) + b" " * 9, np.cumsum(size + 1) - size - 1, size) >> np.uint64(32)
    order = np.argsort(h, kind="stable")
    i = int(np.flatnonzero(h[order][1:] == h[order][:-1])[0])
    return many[order[i]].decode(), many[order[i + 1]].decode()


def test_a_line_never_matches_itself(spark):
    a, b = words_of_one_key()
    rows = [(1, f"{a} {b} f1 f2 f3"), (2, "f1\nf2\nf3\nf1\nf2\nf3"), (3, f"{b} g1 g2 g3 g4"), (4, f"{a} {b} f1 f2 f3")]
    slim = docs_of(spark, rows).select(F.col("doc_id").alias("doc"), "text")
    got = [(r.doc, r.line) for r in line_dedup.later_matches(slim).collect()]
    assert sorted(got) == sorted(slow_removed(rows)) and (1, 0) not in got


@pytest.mark.parametrize("seed,nearest,run", [(4, 2, 3), (5, 1, 10), (6, 1, 50)])
def test_long_runs_of_a_word_are_dealt_in_blocks(spark, seed, nearest, run):
    rows = line_rows(seed)
    slim = docs_of(spark, rows).select(F.col("doc_id").alias("doc"), "text")
    got = [(r.doc, r.line) for r in line_dedup.later_matches(slim, nearest=nearest, run=run).collect()]
    assert len(got) == len(set(got)) and set(got) == slow_removed(rows)


def test_only_words_of_large_counters_are_counted(spark):
    slim = docs_of(spark, line_rows(7)).select(F.col("doc_id").alias("doc"), "text").repartition(5)
    counts = line_dedup._counters(slim)
    many = Counter(w for r in slim.collect() for w in r.text.lower().split())
    assert sorted(counts[counts > 0].tolist()) == sorted(many.values())  # 150 words, a counter each
    leads = line_dedup._led(line_dedup._sets(slim, spark.sparkContext.broadcast(line_dedup._ranks(counts)), 0.8)).where("lead").cache()
    for run in (3, 10, int(counts.max()), 1 << 16):
        some, all_ = (line_dedup._blocks_of(leads, run, n).value for n in (counts, None))
        assert [x.tolist() for x in some] == [x.tolist() for x in all_] and (len(some[0]) > 0) == (run < 11)
    job = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("blocks", "")
    line_dedup._blocks_of(leads, int(counts.max()), counts)  # no counter is large: nothing is read
    jobs = job.getJobIdsForGroup("blocks")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    leads.unpersist()
    assert not jobs


def test_small_batches_are_met_at_once():
    cuts = [0, 5, 5, 40_000, 90_000, 90_003, 90_003]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(a, b), pa.int64())], names=["x"]) for a, b in zip(cuts, cuts[1:])]
    got = list(line_dedup._larger(iter(batches)))
    assert [b.num_rows for b in got] == [90_000, 3] and [x for b in got for x in b.column("x").to_pylist()] == list(range(90_003))
    assert list(line_dedup._larger(iter([]))) == []


def test_a_common_line_and_word_fill_no_run(spark):
    rng = random.Random(3)
    line = "the very same notice on each page"
    rows = [(d, f"{line}\n" + "\n".join("common " + " ".join(words(9, rng.random(), 10_000)) for _ in range(3))) for d in range(400)]
    slim = docs_of(spark, rows).select(F.col("doc_id").alias("doc"), "text").repartition(4)
    counters = spark.sparkContext.broadcast(np.zeros(line_dedup.COUNTERS, dtype=np.int64))
    sets = line_dedup._sets(slim, counters, 0.3).cache()  # a low threshold: most words are in the prefix
    assert sets.where("not gone and size = 7").count() == 4  # one a piece of texts
    leads = line_dedup._led(sets).where("lead")
    assert leads.where("size = 7").select("doc", "line").collect() == [(0, 0)]
    index = line_dedup._index(leads, line_dedup._blocks_of(leads, 100))
    largest = index.groupBy("word", "cell").count().agg(F.max("count")).first()[0]
    assert leads.count() == 1201 and largest < 300
    sets.unpersist()


def test_line_dedup_cuts_and_keeps(spark):
    rows = [(2, "a b c\n\nkeep me"), (1, "first one\nA  B c"), (3, None), (None, "first one\nnew"), (2, "keep me\nown"), (4, ""),
            (5, "very " * 100_000)]
    left = line_dedup.dedup_lines(docs_of(spark, rows, RICH))
    assert left.columns == docs_of(spark, [], RICH).columns
    out = sorted((str(r.doc_id), r.text if r.text is None else r.text[:30]) for r in left.collect())
    assert out == sorted([("1", "first one\nA  B c"), ("2", "\nkeep me"), ("3", None), ("None", "new"), ("2", "own"), ("4", ""),
                          ("5", ("very " * 100)[:30])])
    assert line_dedup.dedup_lines(docs_of(spark, [])).count() == 0
    assert line_dedup.line_report(docs_of(spark, [])).count() == 0


# 6 token files and 10 packing --------------------------------------------

def library_ids(name, rows, end):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary(name))
    t.encode_special_tokens = True
    return [np.array(e.ids + [end], dtype="<u4") for e in t.encode_batch([r or "" for r in rows], add_special_tokens=False)]


@pytest.mark.parametrize("name,parts", [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "spaces")])
def test_parts_give_the_library_ids(name, parts, texts):
    rng = random.Random(6)
    rows = list(texts.values()) + ["".join(rng.choice("aB é'1.,\n\t   ́ñß漢<|endoftext|>\x1c\x85sİΣ") for _ in range(rng.randint(0, 40)))
                                   for _ in range(3000)]
    rows += ["", " ", "\n\n a", "a  b", "it's 's", "x" * 5000, "y " * 5000]
    e = Encoder(vocabulary(name), parts)
    assert e.mark is not None
    for rows in (rows, rows, ["\u263c", "a \u263c b\u263cc", "new\n\nwords"]):  # without the cache, with it, with the mark
        assert [x + b"\1\0\0\0" for x in e.encode(rows)] == [x.tobytes() for x in library_ids(name, rows, 1)]


@pytest.mark.parametrize("name,parts", [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "spaces")])
def test_strings_of_added_tokens_are_encoded_as_by_the_library(name, parts):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(vocabulary(name))
    rng = random.Random(8)
    rows = ["".join(rng.choice(["a", " ", "\n", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "bc", "<|"]) for _ in range(rng.randint(1, 12)))
            for _ in range(500)]
    want = [np.array(plain.encode(r, add_special_tokens=False).ids, dtype="<u4").tobytes() for r in rows]
    e = Encoder(vocabulary(name), parts)
    assert e.encode(rows) == want and e.encode(rows) == want


def test_perfect_hash_is_minimal_and_perfect():
    for n in (0, 1, 2, 63, 1000, 20_000):
        keys = token_files._hashes(np.arange(n, dtype=np.int64) * 7 - 3)
        mph = token_files.PerfectHash.build(keys)
        assert sorted(mph.slots(keys).tolist()) == list(range(n))


def test_token_files_round_trip(spark, texts, tmp_path):
    rows = sorted(texts.items()) + [(10_000, None), (10_001, ""), (-5, "negative key"), (10_002, "long " * 50_000)]
    rows += [(10_003, f"copy {i}") for i in range(100)]  # one hot key
    rows += [(None, "no key"), (None, "none either")]
    docs, path = docs_of(spark, rows), str(tmp_path / "shards")
    token_files.write_shards(docs.repartition(5), path, vocabulary("word_bpe_49k.json"), end_id=2, docs_per_shard=30)
    assert spark.read.parquet(f"{path}/shards").count() > 5
    got = token_files.read_documents(spark, path, docs.select("doc_id")).orderBy("start").collect()
    assert len(got) == len(rows)
    at = 0
    for r in got:  # gapless, in ascending key order, nulls last
        assert r.start == at
        at += len(r.ids) // 4
    keys = [1 << 62 if r.doc_id is None else r.doc_id for r in got]
    assert keys == sorted(keys)
    ids = {}
    for (d, _), x in zip(rows, library_ids("word_bpe_49k.json", [t for _, t in rows], 2)):
        ids.setdefault(d, []).append(x.tobytes())
    found = {}
    for r in got:
        found.setdefault(r.doc_id, []).append(bytes(r.ids))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in ids.items()}
    unknown = spark.createDataFrame([(777_777,), (0,)], "doc_id long")
    assert [r.doc_id for r in token_files.read_documents(spark, path, unknown).collect()] == [0]
    token_files.write_shards(docs_of(spark, []), path + "-none", vocabulary("word_bpe_49k.json"), end_id=2)
    assert token_files.read_documents(spark, path + "-none", docs.select("doc_id")).count() == 0


@pytest.mark.parametrize("limits", [{"payload_bytes": 5000}, {"docs_per_shard": 30}])
def test_shards_are_bounded_by_bytes_and_documents(spark, tmp_path, monkeypatch, limits):
    monkeypatch.setattr(token_files, "MAX_SHARDS", 2)
    rows = [(d, " ".join(words(rng, d))) for d, rng in ((d, 20 + 37 * d % 900) for d in range(400))]
    rows += [(500, "long " * 20_000)] + [(501, f"copy {i} " * 30) for i in range(50)]
    docs, path = docs_of(spark, rows), str(tmp_path / "shards")
    token_files.write_shards(docs.repartition(3), path, vocabulary("word_bpe_49k.json"), end_id=2, **limits)
    shards = spark.read.parquet(f"{path}/shards").collect()
    assert all(len(s.payload) <= 5000 or s.docs == 1 for s in shards) if "payload_bytes" in limits else all(s.docs <= 60 for s in shards)
    got = token_files.read_documents(spark, path, docs.select("doc_id")).orderBy("start").collect()
    want = {}
    for (d, _), x in zip(rows, library_ids("word_bpe_49k.json", [t for _, t in rows], 2)):
        want.setdefault(d, []).append(x.tobytes())
    at, found = 0, {}
    for r in got:
        assert r.start == at
        at += len(r.ids) // 4
        found.setdefault(r.doc_id, []).append(bytes(r.ids))
    assert [r.doc_id for r in got] == sorted(d for d, _ in rows)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}


def check_pieces(pieces, ids, tokens, segments, loss):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(ids)
    for d, own in by_doc.items():
        own.sort(key=lambda p: p.start)
        assert [p.start for p in own] == [0, *np.cumsum([p.length for p in own])[:-1]]
        assert b"".join(bytes(p.ids) for p in own) == ids[d] and all(p.doc_tokens * 4 == len(ids[d]) for p in own)
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [0, *np.cumsum([p.length for p in own])[:-1]]
        assert sum(p.length for p in own) <= tokens and len(own) <= segments and sum(p.loss_tokens for p in own) <= loss
    return [sum(p.length for p in own) for own in by_sequence.values()]


def test_packing_round_trip(spark, texts):
    rows = sorted(texts.items()) + [(10_000, None), (10_001, ""), (10_002, "long " * 50_000)]
    ids = {d: x.tobytes() for (d, _), x in zip(rows, library_ids("byte_bpe_50k.json", [t for _, t in rows], 0))}
    pieces = packing.pack(docs_of(spark, rows).repartition(3), vocabulary("byte_bpe_50k.json"), 0).collect()
    full = check_pieces(pieces, ids, 1024, packing.MAX_SEGMENTS, 1024)
    assert sum(1024 - n for n in full) <= 3 * 1023  # only a task's last sequence is short
    assert packing.pack(docs_of(spark, []), vocabulary("byte_bpe_50k.json"), 0).count() == 0
    assert packing.pack(docs_of(spark, [(None, "a"), (1, "b"), (1, "b")]), vocabulary("byte_bpe_50k.json"), 0).count() == 3


def test_packing_keeps_three_limits(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(words(rng.randint(0, 60), i)), rng.randint(0, 40)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, prompt long")
    ids = {d: x.tobytes() for (d, _, _), x in zip(rows, library_ids("byte_bpe_50k.json", [r[1] for r in rows], 0))}
    for loss, segments in ((256, 64), (60, 64), (256, 2)):
        pieces = packing.pack(docs, vocabulary("byte_bpe_50k.json"), 0, loss_from="prompt", tokens=256, segments=segments,
                              loss_tokens=loss, window=100).collect()
        check_pieces(pieces, ids, 256, segments, loss)
        prompt = {r[0]: r[2] for r in rows}
        assert all(p.loss_tokens == max(0, p.start + p.length - max(p.start, prompt[p.doc_id])) for p in pieces)


# 7 HTML extraction -------------------------------------------------------

def test_folding_and_alignment():
    li = ("=", ("li", "#"))
    assert html_wrapper.fold((li, li, li, "#")) == (("+", (li,)), "#")
    assert html_wrapper.fold(("#", li, "#", li)) == (("+", ("#", li)),)
    a = html_wrapper.stream("<body><h1>x</h1><p>a</p></body>")
    b = html_wrapper.stream("<body><h1>y</h1><p>a</p><p>b</p><i>c</i></body>")
    assert a == (("=", ("body", ("=", ("h1", "#")), ("=", ("p", "#")))),)
    both = html_wrapper.align(a, b)
    assert both == (("=", ("body", ("=", ("h1", "#")), ("+", (("=", ("p", "#")),)), ("?", (("=", ("i", "#")),)))),)
    assert html_wrapper.align(both, a) == both and html_wrapper.align(both, b) == both
    assert html_wrapper._load(html_wrapper._dump(both)) == both
    assert html_wrapper.slots(both) == {("body", "h1"), ("body", "p"), ("body", "i")}


def test_a_wrapper_has_the_slots_of_all_its_pages():
    rng = random.Random(9)

    def some(depth):
        return "".join(rng.choice(["t ", "<br>", f"<p>{some(depth - 1) if depth else 'x'}</p>", "<ul><li>a<li>b</ul>",
                                   f"<div class=c{rng.randrange(3)}>{some(depth - 1) if depth else ''}</div>"]) for _ in range(rng.randint(0, 5)))

    for _ in range(60):
        pages = [html_wrapper.stream(some(3)) for _ in range(6)]
        wrapper = pages[0]
        for p in pages[1:]:
            wrapper = html_wrapper.align(wrapper, p)
        assert set().union(*map(html_wrapper.slots, pages)) == html_wrapper.slots(wrapper)


PAGE = ("<html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li><a href='/'>menu</a></li></ul></nav>"
        "<div class=\"ad\">buy</div><header><p>site</p></header>{}<aside>side</aside><form><label>in</label></form>"
        "<div id='comments'><p>reader says</p></div><div class='cookie-notice'>accept</div><footer>&copy; x</footer></body></html>")


def test_html_extraction(spark):
    pages = [(1, "http://a.com/1", PAGE.format("<article><h1>Big\n  title</h1><p>One <b>bo</b>ld &amp; &lt;x&gt;&nbsp;y<br>two<p>three</article>"),
              "Big title One bold & <x> y two three"),
             (2, "http://a.com/2", PAGE.format("<article><h1>B</h1><script>if (a<b) x('</p>')</script><ul><li>i<li>j</ul>"
                                               "<div class=\"ad\">buy</div><p>é 😀</p></article>"), "B i j é 😀"),
             (3, "http://b.com/", PAGE.format("<main><p>m</p></main>"), "m"),
             (4, "http://c.com/", PAGE.format("<div class='post-content'><p>c1<p>c2</div>"), "c1 c2"),
             (5, None, None, ""), (6, "x", "", ""), (7, "http://d.com", "just text", "just text"),
             (8, "http://d.com", PAGE.format("<p>bare</p>"), "bare"), (9, "http://e.com", "<article><p>open <b", "open"),
             (10, "http://e.com", "<article>" + "<p>z</p>" * 20_000 + "</article>", " ".join("z" * 20_000)),
             (11, "http://e.com", "<article>" + "<div>" * 300 + "deep" + "</div>" * 300 + "</article>", "deep"),
             (12, "http://e.com", "<!-- <article>no</article> --><article><!-- > -->yes < 5</article>", "yes < 5")]
    frame = spark.createDataFrame([p[:3] for p in pages] + [(1, *pages[0][1:3])], "page_id long, url string, html string")
    got = html_wrapper.extract(frame).collect()
    assert len(got) == len(pages) + 1
    want = {p[0]: p[3] for p in pages}
    for r in got:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text), (r.page_id, r.text[:200])
    assert html_wrapper.extract(frame.limit(0)).count() == 0


def test_html_extraction_of_the_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in html_wrapper.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        text = html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", body)))
        assert got[r.page_id] == re.sub(r"\s+", " ", text).strip()


def site(n, article):
    return (f"<html><body><div class=zq><ul><li>Home</li><li>About us</li></ul></div><p class=xk>Prices are net of tax, page {n}</p>"
            f"{article}<div class=zz><p>Notice: all rights are ours</p></div></body></html>")


def test_what_all_pages_of_a_host_have_is_no_main_text(spark):
    rows = [(n, f"http://a.com/{n}", site(n, f"<div class=qq><p>Text {n} of <b>one</b>, two</p><p>Own {n * 7}</p></div>")) for n in range(5)]
    rows += [(9, "http://b.com/9", rows[0][2])]  # alone on its host: no template
    rows += [(20 + n, f"http://c.com/{n}", f"<body><article><p>The same long article text<p>Version {n}</article>") for n in range(3)]
    rows += [(30 + n, f"http://d.com/{n}", "<body><p>always the same") for n in range(2)]
    rows += [(40 + n, f"http://e.com/{n}", f"<article><p>A long enough text of article number {n}<p>Share</article>") for n in range(3)]
    got = {r.page_id: r.text for r in html_wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n in range(5):
        assert got[n] == f"Prices are net of tax, page {n} Text {n} of one, two Own {n * 7}"
    assert "Home" in got[9] and "Notice" in got[9]
    assert [got[20 + n] for n in range(3)] == [f"The same long article text Version {n}" for n in range(3)]
    assert got[30] == got[31] == "always the same"
    assert [got[40 + n] for n in range(3)] == [f"A long enough text of article number {n}" for n in range(3)]


def test_a_wrong_template_changes_the_text():
    def made(*pages):
        out = {}
        for page in pages:
            out = html_wrapper.common(out, html_wrapper.template_of(page))
        assert html_wrapper._read(html_wrapper._write(out)) == out
        return out

    a, b = (f"<body><div><p>{n} own</p></div><div>menu</div><p>foot</p></body>" for n in "12")
    other = [f"<body><div><p>1 own</p></div><div>{n}</div></body>" for n in "34"]
    assert html_wrapper.Extractor(made(a, b)).text(a) == "1 own"
    assert html_wrapper.Extractor(made(a, a)).text(a) == "1 own menu foot"
    assert html_wrapper.Extractor(made(*other)).text(a) == "menu foot"
    assert made(a, b, *other) == html_wrapper.common(made(*other), made(b, a))


def test_the_wrapper_aligns_the_texts_of_a_host():
    def made(*pages):
        out = {}
        for page in pages:
            out = html_wrapper.common(out, html_wrapper.template_of(page))
        return out

    # one path, two places: equal at one, not at the other; an optional notice of some pages
    pages = [f"<body><div><p>Offer</p></div><div><p>{n} own</p></div>{'<pre>Notice</pre>' if n % 2 else ''}<p>foot {n}</p></body>" for n in range(5)]
    wrapper = made(*pages)
    (kind, (body, first, second, notice, foot)), = wrapper["wrapper"]
    assert (kind, body, notice[0]) == ("=", "body", "?") and len(first[1][1][1][1][1]) == 3 and len(second[1][1][1][1][1]) == 2
    for n, page in enumerate(pages):
        assert html_wrapper.Extractor(wrapper).text(page) == f"{n} own foot {n}"
    # menus of different length are repeated groups; what all pages have in them is template
    menus = [f"<body><ul><li>Home</li>{f'<li>only {n}</li>' * (n > 0)}<li>About</li></ul><p>{n} own</p></body>" for n in range(3)]
    assert [html_wrapper.Extractor(made(*menus)).text(m) for m in menus] == ["0 own", "only 1 1 own", "only 2 2 own"]
    # the pages of other hosts make another wrapper
    assert html_wrapper.Extractor(made(*menus)).text(pages[0]) == "Offer 0 own foot 0"


def test_a_wrapper_of_very_different_pages_stays_small():
    rng = random.Random(3)
    sizes, wrapper = [], {}
    for n in range(200):
        rows = "".join(f"<{t}>{n} {i}</{t}>" for i, t in enumerate(rng.choices(["p", "h2", "pre", "div", "section", "table"], k=rng.randint(20, 60))))
        wrapper = html_wrapper.common(wrapper, html_wrapper.template_of(f"<body>{rows}<p>foot</p></body>"))
        sizes.append(len(html_wrapper._write(wrapper)))
    assert sizes[-1] <= max(sizes[:50]) and max(sizes[50:]) < 2000
    assert html_wrapper.Extractor(wrapper).text("<body><h2>mine</h2><p>foot</p></body>") == "mine"


@pytest.mark.parametrize("page,text", [
    ("<div class='page has-sidebar'><article><p>a</p></article></div>", "a"),
    ("<div id='wrap' class='no-sidebar'><article><p>a</p><section id='related-work'><p>r</p></section></article></div>", "a r"),
    ("<div class='page has-sidebar'><p>a long text</p><div class='sidebar'>s</div></div>", "a long text"),
    ("<div class='sidebar'><p>all of the text is here</p></div>", "all of the text is here"),
    ("<form><div class='widget'><article><p>a</p><div class='main-nav'>n</div></article></div></form>", "a"),
    ("<article><p>short</p><section class='comments'><p>a very long comment of a reader</p></section></article>", "short"),
    ("<header><h1>Site</h1></header><article><header><h1>T</h1></header><p>a</p></article><div class='site-footer'>f</div>", "T a"),
    ("<nav>only a menu</nav>", "")])
def test_layout_classes_keep_the_article(page, text):
    assert html_wrapper.Extractor({}).text(f"<html><body>{page}</body></html>") == text


# 8 exact dedup -----------------------------------------------------------

def test_exact_dedup_equals_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, rng.choice(["same", "SAME", "other", "", None, "x" * 300 + "a", "x" * 300 + "b", "É", "é", f"own {i}"])) for i in range(200)]
    rows += [(None, "same"), (None, "only null"), (7, rows[7][1])]

    def norm(t):
        return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")

    keep = {}
    for d, t in rows:
        keep.setdefault(norm(t), []).append(d)
    want = sorted((str(d), str(k), len(g), d == k) for d, t in rows for g in [keep[norm(t)]]
                  for k in [max((x for x in g if x is not None), default=None)])
    for small in (True, False):  # with and without a broadcast of the open groups
        monkeypatch.setattr(exact_dedup, "broadcastable", lambda m: small)
        got = exact_dedup.exact_dedup(docs_of(spark, rows, RICH)).collect()
        assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in got) == want
    assert exact_dedup.exact_dedup(docs_of(spark, [])).count() == 0


# 9 quality ---------------------------------------------------------------

def test_isotonic_rises_and_fits():
    at, value = quality.isotonic(np.arange(6.0), np.array([0, .4, .2, .2, 1, .9]), np.ones(6))
    assert (np.diff(value) > 0).all() and np.isclose(value[1], 0.8 / 3) and np.isclose(value[-1], 0.95)


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.quality_scores(docs, labels).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    held = [(got[r.doc_id], r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert np.mean([s.predicted == y for s, y in held]) > 0.93
    good, bad = ([s.score for s, y in held if y == v] for v in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.95


def test_quality_edges(spark):
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(80)] + [(1, 0, None), (2, None, None), (None, 1, None), (3, 7, None)],
                                   "doc_id long, quality int, text string")
    rows = [(i, "good words here. " * 5 if i % 2 else "### $$$ 12 %% " * 5) for i in range(100)] + [(None, None), (200, ""), (5, "x" * 500_000)]
    got = quality.quality_scores(docs_of(spark, rows, RICH), labels).collect()
    assert len(got) == len(rows) and all(r.score is not None and 0 <= r.score <= 1 for r in got)
    none = labels.limit(0)
    assert all(r.score == 1 and r.predicted == 1 for r in quality.quality_scores(docs_of(spark, rows), none).collect())
    left = quality.keep_good(docs_of(spark, rows, RICH), labels)
    assert left.columns == docs_of(spark, [], RICH).columns and 0 < left.count() < len(rows)
    assert quality.quality_scores(docs_of(spark, []), labels).count() == 0
    assert all(len(quality.statistics(t)) == quality.STATISTICS for t in (b"", b" ", b"a", "é\n".encode() * 1000))
