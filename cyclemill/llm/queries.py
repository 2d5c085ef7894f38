"""The operators as queries over the given tables, by the contracts of their results, with SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemill.llm import (
    collocations, decontamination, extraction, language, licenses, merkle, packing, pii, quality, secrets, simhash, topk, toxicity,
)
from cyclemill.llm.common import fresh, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def held_out(parts: int, part: int):
    """Whether the crc32 of the id as text leaves that remainder; a null id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == part, F.lit(False))


def joined_spans(spans, kind: str = "kind"):
    """kind:start:end of sorted spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s[kind], s["start"], s["end"])), ",")


def base_spans(spans, kinds):
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def n_of(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


@query()
def op1_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """SimHash fingerprints of all documents and their components."""
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op2_licenses(spark: SparkSession, sf: str) -> DataFrame:
    """Exact and fuzzy licence notices of all documents."""
    c = fresh("found")
    found = table(spark, sf, "documents").select("doc_id", licenses.licenses().alias(c))
    return found.select(
        "doc_id", f"{c}.n_words", f"{c}.n_base", f"{c}.first_word", f"{c}.last_word",
        F.array_join(f"{c}.base_labels", ",").alias("base_labels"), F.array_join(f"{c}.labels", ",").alias("labels"),
        f"{c}.score", F.array_join(F.transform(f"{c}.spans", lambda s: F.concat_ws(
            ":", s["label"], s["start"], s["end"], s["edits"])), ",").alias("notices"),
    )


@query()
def op3_private(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data of all documents, and the terms that give it away."""
    spans = F.col("spans")
    found = pii.private_spans(table(spark, sf, "documents"))
    return found.select(
        "doc_id", *[n_of(spans, kind).alias(f"n_{kind}") for kind in pii.KINDS[:4]],
        F.sha2(joined_spans(base_spans(spans, pii.KINDS[:4])), 256).alias("base_sha256"), joined_spans(spans).alias("spans"),
        n_of(spans, "term").alias("n_term"),
    )


def toxicity_model(spark: SparkSession, sf: str, docs: DataFrame) -> toxicity.Model:
    """Trained on the labelled documents that are not held out."""
    labels = table(spark, sf, "labels").filter(~held_out(5, 0)).select("doc_id", F.col("toxic").alias("label"))
    return toxicity.train(docs, labels)


@query()
def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of all documents, with the sentences to blame."""
    docs = table(spark, sf, "documents")
    c = fresh("scored")
    model = toxicity_model(spark, sf, docs)
    scored = docs.select("doc_id", toxicity.toxicity(model).alias(c))
    return scored.select(
        "doc_id", held_out(5, 0).alias("held_out"), f"{c}.score",
        F.when(F.col(f"{c}.score") >= 0.5, 1).otherwise(0).alias("predicted"),
        F.array_join(F.transform(f"{c}.sentences", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("sentences"),
    )


@query()
def op5_secrets(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets of all documents."""
    c = fresh("found")
    found = table(spark, sf, "documents").select("doc_id", secrets.secrets().alias(c))
    spans = F.col(c)["spans"]
    return found.select(
        "doc_id", n_of(spans, "assign").alias("n_assign"), n_of(spans, "access").alias("n_access"),
        n_of(spans, "hex").alias("n_hex"),
        F.sha2(joined_spans(base_spans(spans, ("assign", "access", "hex"))), 256).alias("base_sha256"),
        joined_spans(spans).alias("spans"),
    )


@query()
def op6_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of all pages."""
    pages = table(spark, sf, "pages")
    c = fresh("found")
    model = extraction.train(pages)
    found = pages.select("page_id", "url", extraction.main_text(model).alias(c))
    return found.select("page_id", "url", f"{c}.text", F.length(f"{c}.text").cast("long").alias("n_chars"), f"{c}.blocks", f"{c}.kept")


@query()
def op7_language(spark: SparkSession, sf: str) -> DataFrame:
    """Language of all documents."""
    docs = table(spark, sf, "documents")
    c = fresh("predicted")
    model = language.train(docs.filter(F.col("doc_id").isNotNull() & ~held_out(4, 2)))
    predicted = docs.select("doc_id", language.language(model).alias(c))
    return predicted.select(
        "doc_id", held_out(4, 2).alias("held_out"), F.col(f"{c}.lang").alias("lang_pred"), f"{c}.score", f"{c}.rejected")


DECONTAMINATION = r"""WITH cut AS (
  SELECT *, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM (
    SELECT 'd' AS kind, row_number() OVER () AS r, doc_id, NULL AS item, text FROM documents
    UNION ALL SELECT 'b', 0, NULL, CAST(item_id AS VARCHAR), text FROM benchmark WHERE item_id IS NOT NULL)),
phrases AS (
  SELECT item, least(len(w), 13) AS size, array_to_string(list_slice(w, g + 1, g + least(len(w), 13)), ' ') AS phrase FROM (
    SELECT item, w, unnest(range(0, greatest(len(w) - 13, 0) + 1)) AS g FROM cut WHERE kind = 'b' AND len(w) > 0)),
places AS (
  SELECT r, size, g, array_to_string(list_slice(w, g + 1, g + size), ' ') AS phrase FROM (
    SELECT r, w, size, unnest(range(0, greatest(len(w) - size + 1, 0))) AS g
    FROM cut, (SELECT DISTINCT size FROM phrases) WHERE kind = 'd')),
found AS (SELECT DISTINCT r, g, size, item FROM places JOIN phrases USING (size, phrase)),
hits AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(g, g + size)) AS place FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM cut LEFT JOIN hits USING (r) LEFT JOIN named USING (r) WHERE kind = 'd'"""


@query(DECONTAMINATION)
def op8_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark passages in all documents."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, table(spark, sf, "benchmark"))
    c = found.columns[-1]
    return found.select(
        "doc_id", f"{c}.n_words", f"{c}.n_hit", f"{c}.n_items",
        F.sha2(F.array_join(f"{c}.items", ","), 256).alias("items_sha256"), f"{c}.contaminated",
    )


@query()
def op9_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces of all documents in sequences of 2,048 tokens."""
    return packing.packed(table(spark, sf, "documents"))


TOPK = """WITH fine AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM fine q JOIN fine c ON q.r <> c.r WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5"""


@query(TOPK)
def op10_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The five best inner products of every 50th vector with all others."""
    return topk.top_inner_products(table(spark, sf, "embeddings"))


COLLOCATIONS = r"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
cut AS (SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT p, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM cut),
followed AS (
  SELECT lang, w1, lead(w1) OVER places AS w2, lead(w1, 2) OVER places AS w3 FROM places WINDOW places AS (PARTITION BY p ORDER BY i)),
one AS (SELECT lang, w1, count(*) AS f FROM followed GROUP BY lang, w1),
two AS (SELECT lang, w1, w2, count(*) AS f FROM followed WHERE w2 IS NOT NULL GROUP BY lang, w1, w2),
three AS (SELECT lang, w1, w2, w3, count(*) AS f FROM followed WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3 HAVING count(*) >= 10),
totals AS (SELECT lang, sum(f) AS n FROM one GROUP BY lang),
cuts AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, c.f AS a, 1 AS k, l.f AS l, r.f AS r
  FROM two c JOIN one l ON l.lang = c.lang AND l.w1 = c.w1 JOIN one r ON r.lang = c.lang AND r.w1 = c.w2
  WHERE c.f >= 10 AND NOT EXISTS (SELECT 1 FROM three b WHERE b.lang = c.lang AND b.w1 = c.w1 AND b.w2 = c.w2 AND 100 * b.f >= 50 * c.f)
    AND NOT EXISTS (SELECT 1 FROM three b WHERE b.lang = c.lang AND b.w2 = c.w1 AND b.w3 = c.w2 AND 100 * b.f >= 50 * c.f)
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 1, l.f, r.f
  FROM three c JOIN one l ON l.lang = c.lang AND l.w1 = c.w1 JOIN two r ON r.lang = c.lang AND r.w1 = c.w2 AND r.w2 = c.w3
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 2, l.f, r.f
  FROM three c JOIN two l ON l.lang = c.lang AND l.w1 = c.w1 AND l.w2 = c.w2 JOIN one r ON r.lang = c.lang AND r.w1 = c.w3),
scored AS (SELECT *, (CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM lowest JOIN totals USING (lang) QUALIFY rank <= 2000"""


@query(COLLOCATIONS)
def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    """Every language's best phrases of two and three words."""
    return collocations.collocations(table(spark, sf, "documents"))


def merkle_sql(levels: int = 12) -> str:
    """Runs of eight, level by level; twelve levels hold more leaves than a table has."""
    field = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
    row = lambda text: "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    sql = f"""WITH crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, CAST(i AS BIGINT))) AS t),
rows AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {row("text")} AS leaf,
    CASE WHEN xor(4294967295, list_reduce(list_transform(regexp_extract_all(CAST(doc_id AS VARCHAR), '.'), lambda d: CAST(ascii(d) AS BIGINT)),
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), CAST(4294967295 AS BIGINT))) % 3 = 0
    THEN {row(lowered)} END AS changed FROM documents, crc_table),
n0 AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS h FROM rows),
l0 AS (SELECT tree, pos, h FROM n0)"""
    for kind in ("l", "t"):
        if kind == "t":
            sql += f""",
t0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, h, tree AS own FROM l{levels})"""
        for k in range(1, levels + 1):
            # a tree that is down to one node goes up as it is
            sql += f""",
{kind}{k} AS (
  SELECT tree, CASE WHEN n = 1 THEN 0 ELSE pos // 8 END AS pos, CASE WHEN n = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {kind}{k - 1}) GROUP BY tree, n, CASE WHEN n = 1 THEN 0 ELSE pos // 8 END)"""
    # the path of a row: its place on every level, the siblings there, and the hash with its own leaf changed
    sql += """,
p0 AS (SELECT n0.*, coalesce(changed, leaf) AS f, '' AS proof, t0.pos AS top FROM n0 JOIN t0 ON t0.own = n0.tree)"""
    last = "p0"
    for kind in ("l", "t"):
        for k in range(1, levels + 1):
            now, tree = f"p{kind}{k}", "p.tree" if kind == "l" else "''"
            at = "p.pos" if kind == "l" else "p.top"
            rest = "p.* EXCLUDE (f, proof, pos)" if kind == "l" else "p.* EXCLUDE (f, proof, top)"
            sql += f""",
r{kind}{k} AS (SELECT tree, pos // 8 AS run, list(h ORDER BY pos) AS hs, any_value(n) AS n
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {kind}{k - 1}) GROUP BY tree, pos // 8),
{now} AS (
  SELECT {rest}, CASE WHEN n = 1 THEN {at} ELSE {at} // 8 END AS {at[2:]},
    CASE WHEN n = 1 THEN f ELSE sha256(array_to_string(hs[1:{at} % 8], '') || f || array_to_string(hs[{at} % 8 + 2:], '')) END AS f,
    CASE WHEN n = 1 THEN proof ELSE proof || array_to_string(hs[1:{at} % 8], '') || array_to_string(hs[{at} % 8 + 2:], '') END AS proof
  FROM {last} p JOIN r{kind}{k} r ON r.tree = {tree} AND r.run = {at} // 8)"""
            last = now
    return sql + f"""
SELECT doc_id, leaf, l{levels}.h AS subroot, t{levels}.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = t{levels}.h AS verified
FROM {last} p JOIN l{levels} ON l{levels}.tree = p.tree CROSS JOIN t{levels}"""


@query(merkle_sql())
def op12_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Merkle leaves, proofs and their verification for all documents, every third of them changed."""
    docs = table(spark, sf, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    leaves = docs.select(
        "doc_id", "lang", merkle.record_hash(*fields, F.col("text")).alias("leaf"),
        F.when(changed, merkle.record_hash(*fields, merkle.lower_ascii(F.col("text")))).alias("changed"))
    made = merkle.manifest(leaves, "lang", "doc_id")
    claims = made.leaves.withColumn("claimed", F.coalesce("carried.changed", "leaf"))
    found = made.proofs(claims, "claimed")
    return found.select(
        F.col("carried.doc_id").alias("doc_id"), "leaf", "subroot", F.lit(made.root).cast("string").alias("root"),
        F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"), F.col("folded").alias("folded_root"),
        (F.col("folded") == F.lit(made.root)).alias("verified"))


@query()
def op13_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Plain counts, perplexity and verdict of all documents."""
    found = quality.quality(table(spark, sf, "documents").select("doc_id", "lang", "text"))
    c = found.columns[-1]
    return found.select("doc_id", *[f"{c}.{name}" for name in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score", "lower", "upper")])
