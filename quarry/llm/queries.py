"""The registered queries of the operators (production parameters, whole
tables) and their DuckDB oracles where SQL can express them."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (decontaminate, exact_dedup, filter_audit, html_wrapper, line_dedup, merkle, ngram_join, packing, pii,
                        quality, simhash, token_files, url_filter)
from quarry.llm.common import table
from quarry.llm.tokens import vocabulary
from quarry.session import fresh_dir


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages")).drop("url")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(pii.find_pii(table(spark, sf_dir, "documents")))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), fresh_dir(spark, "llm/token_files")
    token_files.write_shards(docs, path, vocabulary("word_bpe_49k.json"), end_id=2)
    found = token_files.read_documents(spark, path, docs.select("doc_id"))
    return found.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.crc32("ids").alias("ids_crc32"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract(table(spark, sf_dir, "pages"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    digest = F.sha2(exact_dedup.normalised(docs["text"]), 256)
    return exact_dedup.exact_dedup(docs, carry={"text_sha256": digest})


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_classes(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    more = (docs["n_chars"].cast("decimal(20,0)") + 1).cast("string")
    return merkle.manifest(docs, altered=F.crc32(docs["doc_id"].cast("string")) % 7 == 0, presented={"n_chars": more})


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_url_filter, op3_pii, op4_simhash, op5_line_dedup, op6_token_files,
                                   op7_html_extraction, op8_exact_dedup, op9_quality, op10_packing,
                                   op11_ngram_join, op12_merkle_manifest, op13_filter_audit)}



def _cell(value: str) -> str:
    """A field of a leaf in the oracle."""
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


_ORDERS = ", ".join(f"('{''.join(o)}')" for o in permutations("ABCDE"))
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE = {
    "op2_url_filter": f"""
WITH rest AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
     parts AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), {_AZ}) AS host,
                      regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
     rules(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
                      ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
     fits AS (SELECT page_id, max_by({{'rule': rhost || rpath, 'verdict': rules.verdict}}, length(rhost || rpath)) AS best
              FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
              GROUP BY page_id)
SELECT p.page_id, p.host, p.path, f.best.rule AS rule, coalesce(f.best.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f USING (page_id)""",
    "op8_exact_dedup": f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), {_AZ}) AS t FROM documents),
     g AS (SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, sha256(t) AS text_sha256
           FROM n WINDOW w AS (PARTITION BY t))
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM g""",
    "op11_ngram_join": f"""
WITH RECURSIVE
     d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
     u AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM d),
     l AS (SELECT doc_id, i, concat_ws(' ', a, lead(a, 1) OVER o, lead(a, 2) OVER o, lead(a, 3) OVER o, lead(a, 4) OVER o) AS gram,
                  lead(a, 4) OVER o AS fifth FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
     g AS MATERIALIZED (SELECT DISTINCT doc_id, gram FROM l WHERE i = 1 OR fifth IS NOT NULL),
     n AS MATERIALIZED (SELECT d.doc_id, count(gram) AS n FROM d LEFT JOIN g ON g.doc_id = d.doc_id GROUP BY d.doc_id),
     i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
     e AS MATERIALIZED (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
     both_ways AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
     reach(doc_id, other) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, b FROM reach r JOIN both_ways ON a = r.other)
SELECT n.doc_id, n.n AS n_shingles, min(other) AS component_id FROM n JOIN reach USING (doc_id) GROUP BY n.doc_id, n.n""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE
     crc AS (SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                    lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
                    lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295) % 7 = 0 AS bad
             FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
     f AS (SELECT d.doc_id, lang, {_cell("d.doc_id")} || {_cell("source")} || {_cell("lang")} AS head, {_cell("text")} AS tail,
                  {_cell("n_chars")} AS n, {_cell("CASE WHEN bad THEN n_chars + 1 ELSE n_chars END")} AS shown
           FROM documents d LEFT JOIN crc USING (doc_id)),
     leaf AS (SELECT doc_id, lang, sha256(head || n || tail) AS h, sha256(head || shown || tail) AS shown FROM f),
     leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
                       dense_rank() OVER (ORDER BY lang NULLS FIRST) AS part FROM leaf),
     up(part, lvl, pos, h, n) AS (
         SELECT part, 0, pos, h, count(*) OVER (PARTITION BY part) FROM leaves
         UNION ALL
         SELECT part, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2
         FROM up WHERE n > 1 GROUP BY part, lvl, pos // 2),
     top(lvl, pos, h, n) AS (
         SELECT 0, part - 1, h, count(*) OVER () FROM up WHERE n = 1
         UNION ALL
         SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2
         FROM top WHERE n > 1 GROUP BY lvl, pos // 2),
     steps AS (
         SELECT l.part, l.pos, u.lvl, l.pos >> u.lvl AS node, s.h AS sib
         FROM leaves l JOIN up u ON u.part = l.part AND u.n > 1 AND u.pos = l.pos >> u.lvl
         LEFT JOIN up s ON s.part = u.part AND s.lvl = u.lvl AND s.pos = xor(u.pos, 1)
         UNION ALL
         SELECT l.part, l.pos, 1000 + t.lvl, (l.part - 1) >> t.lvl, s.h
         FROM leaves l JOIN top t ON t.n > 1 AND t.pos = (l.part - 1) >> t.lvl
         LEFT JOIN top s ON s.lvl = t.lvl AND s.pos = xor(t.pos, 1)),
     paths AS (SELECT part, pos, list(struct_pack(odd := node % 2 = 1, sib := coalesce(sib, '')) ORDER BY lvl) AS path,
                      sha256(string_agg(coalesce(sib, ''), '' ORDER BY lvl)) AS proof FROM steps GROUP BY part, pos),
     walk(part, pos, h, path) AS (
         SELECT l.part, l.pos, l.shown, coalesce(p.path, []) FROM leaves l LEFT JOIN paths p USING (part, pos)
         UNION ALL
         SELECT part, pos, sha256(CASE WHEN path[1].odd THEN path[1].sib || h ELSE h || path[1].sib END), path[2:]
         FROM walk WHERE len(path) > 0)
SELECT l.doc_id, l.h AS leaf, u.h AS subroot, t.h AS root, coalesce(p.proof, sha256('')) AS proof_sha256, w.h AS folded_root,
       w.h = t.h AS verified
FROM leaves l JOIN up u ON u.part = l.part AND u.n = 1 JOIN top t ON t.n = 1 LEFT JOIN paths p ON p.part = l.part AND p.pos = l.pos
JOIN walk w ON w.part = l.part AND w.pos = l.pos AND len(w.path) = 0""",
    "op13_filter_audit": f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
     l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
     f AS (SELECT part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
                         100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'),
                         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails,
                  coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM d LEFT JOIN l USING (doc_id)),
     c AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
     o AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM (VALUES {_ORDERS}) v(filter_order)),
     s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own,
                  list_transform(range(1, step), lambda k: instr('ABCDE', substr(filter_order, k, 1))) AS earlier,
                  instr('ABCDE', substr(filter_order, step, 1)) AS i FROM o),
     m AS (SELECT c.*, s.*, fails[i] AS bad, list_bool_or(list_transform(earlier, lambda k: fails[k])) IS TRUE AS gone,
                  len(list_filter(fails, lambda x: x)) = 1 AS single FROM c, s),
     r AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT gone AND NOT bad), 0) AS kept,
                  coalesce(sum(n) FILTER (NOT gone AND bad), 0) AS removed, coalesce(sum(n) FILTER (gone AND bad), 0) AS redundant,
                  coalesce(sum(n) FILTER (bad AND single), 0) AS unique_fails,
                  coalesce(sum(n) FILTER (NOT gone AND bad AND good), 0) AS good_lost,
                  coalesce(sum(n) FILTER (NOT gone AND bad AND toxic), 0) AS toxic_lost
           FROM m GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r""",
}
