"""Registered queries of the corpus operators, with check SQL where SQL can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsalpha.llm import benchmark, bpe, codes, common, edits, grid_join, language, licenses, lines, minhash, secrets, sharding, spellings, wrappers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Lines of the documents; the set of words of each; every pair that shares a word is compared.
LINE_DEDUP = r"""
WITH docs AS (SELECT doc_id, text, str_split(text, chr(10)) AS every FROM documents),
all_lines AS (SELECT doc_id, unnest(range(len(every))) AS place, unnest(every) AS line FROM docs),
sets AS (
  SELECT doc_id, place, line, row_number() OVER (ORDER BY doc_id, place) AS number,
    list_sort(list_distinct(list_filter(str_split_regex(lower(line), '[ \t\n\x0B\f\r]+'), lambda w: w <> ''))) AS words
  FROM all_lines),
firsts AS (SELECT words, len(words) AS n, min(number) AS first FROM sets WHERE len(words) > 0 GROUP BY words),
posted AS (SELECT first, n, unnest(words) AS word FROM firsts),
shared AS (
  SELECT a.first AS x, b.first AS y, a.n AS n, b.n AS m, count(*) AS o
  FROM posted a JOIN posted b ON a.word = b.word AND a.first < b.first AND 10 * least(a.n, b.n) >= 8 * greatest(a.n, b.n)
  GROUP BY ALL),
later AS (SELECT DISTINCT y FROM shared WHERE 100 * o >= 80 * (n + m - o)),
stays AS (
  SELECT s.doc_id, s.place, s.line FROM sets s
  WHERE len(words) = 0 OR (number IN (SELECT first FROM firsts) AND number NOT IN (SELECT y FROM later))),
made AS (SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY place) AS text FROM stays GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(every), 0) AS n_lines, coalesce(len(every), 0) - coalesce(m.n, 0) AS n_removed,
  sha256(coalesce(m.text, '')) AS text_sha256
FROM docs d LEFT JOIN made m USING (doc_id)"""

# The table of a checksum follows from its polynomial.
CHECKSUM_STEPS = """steps AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""
# Of a hexadecimal string h, with the table at hand.
CHECKSUM = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(0, len(h), 2), lambda i: CAST('0x' || h[i + 1:i + 2] AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"""

# Sizes and checksums; running totals in order of the id.
SHARDS = f"""
WITH {CHECKSUM_STEPS},
spelled AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
summed AS (
  SELECT doc_id, len(h) // 2 + 16 AS size, {CHECKSUM} AS text_crc32
  FROM spelled, steps),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id) - size AS bytes_before, row_number() OVER (ORDER BY doc_id) AS r, sum(size) OVER () AS total FROM summed),
cut AS (SELECT *, CAST((2 * bytes_before + size) * 40 // (2 * total) AS INT) AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, r - min(r) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INT) AS grown_shard,
  CAST(bytes_before AS BIGINT) AS bytes_before FROM cut"""

# Every pair of vectors.
VECTORS = """
WITH RECURSIVE sound AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL AND list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM sound a JOIN sound b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reached AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y)
SELECT vec_id, (SELECT count(*) FROM links WHERE x = vec_id) AS n_links, (SELECT min(y) FROM reached WHERE x = vec_id) AS component_id,
  vec_id = (SELECT min(y) FROM reached WHERE x = vec_id) AS kept FROM embeddings"""

# Every pair of documents that shares a shingle of four words, counted in full.
NEAR = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(str_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM split),
each_one AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT x, y FROM (
    SELECT a.doc_id AS x, b.doc_id AS y, a.n AS n, b.n AS m, count(*) AS o FROM each_one a JOIN each_one b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY ALL) c WHERE 100 * o >= 80 * (n + m - o)),
reached AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y),
least_one AS (SELECT x, min(y) AS c FROM reached GROUP BY x)
SELECT doc_id, len(s) AS n_shingles, c AS component_id, doc_id = c AS kept FROM sets JOIN least_one ON x = doc_id"""

# Slips by the checksum of each run; near words share what is left when a letter is taken out of one or of both.
SPELLINGS = rf"""
WITH RECURSIVE {CHECKSUM_STEPS},
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
few AS (SELECT doc_id, run, count(*) AS n, hex(encode(concat(doc_id, ':', run))) AS h FROM runs WHERE length(run) >= 7 GROUP BY ALL),
summed AS (SELECT run, n, length(run) AS len, {CHECKSUM} AS crc FROM few, steps),
slipped AS (SELECT n, CASE WHEN crc % 31 = 0 THEN substr(run, 1, crc % len) || substr(run, crc % len + 2) ELSE run END AS word FROM summed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS gone FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word AS x, b.word AS y, b.n AS y_n FROM cut a JOIN cut b ON a.gone = b.gone AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.gone = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.gone = b.word),
best AS (SELECT x, count(*) AS n_near, max(y_n) AS m FROM pairs GROUP BY x),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * w.n THEN (SELECT min(y) FROM pairs p WHERE p.x = w.word AND p.y_n = m) END AS form,
    CASE WHEN m >= 10 * w.n THEN m END AS form_n
  FROM words w LEFT JOIN best ON x = w.word),
walk AS (SELECT word, word AS at FROM forms UNION ALL SELECT k.word, f.form FROM walk k JOIN forms f ON f.word = k.at WHERE f.form IS NOT NULL),
ends AS (SELECT k.word, k.at AS root FROM walk k JOIN forms f ON f.word = k.at WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)"""


def _vector_codes(rounds: int = 2) -> str:
    """Every part against every entry, in each round; distance and index are compared as one number."""
    sql = """
WITH kept AS (
  SELECT vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
spread AS (SELECT vec_id, embedding, len(embedding) // 16 AS width, unnest(range(len(embedding))) AS i FROM kept),
parts AS (SELECT vec_id, i // width AS part, i % width AS place, CAST(floor(256 * CAST(embedding[i + 1] AS DOUBLE)) AS BIGINT) AS x FROM spread),
firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < 64),
book0 AS (SELECT part, entry, place, x AS c FROM parts JOIN firsts USING (vec_id)),"""
    for k in range(rounds + 1):
        sql += f"""
far{k} AS (SELECT vec_id, part, entry, sum((x - c) * (x - c)) AS d FROM parts JOIN book{k} USING (part, place) GROUP BY ALL),
near{k} AS (SELECT vec_id, part, min(d * 64 + entry) % 64 AS entry, min(d * 64 + entry) // 64 AS d FROM far{k} GROUP BY ALL),"""
        if k < rounds:
            sql += f"""
means{k} AS (SELECT part, entry, place, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS m FROM parts JOIN near{k} USING (vec_id, part) GROUP BY ALL),
book{k + 1} AS (SELECT part, entry, place, coalesce(m, c) AS c FROM book{k} LEFT JOIN means{k} USING (part, entry, place)),"""
    return sql + f"""
coded AS (SELECT vec_id, string_agg(format('{{:02x}}', CAST(entry AS INT)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY ALL)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(c, ',' ORDER BY part, entry, place)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""


def _values(rows) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in row) + ")" for row in rows) + ")"


def _license_notices(percent: int = 90) -> str:
    """All words of the documents; every block and notice that share a word are compared, phrases by their neighbours."""
    notices = [(i, label, [w.decode() for w in licenses.parsed(text)]) for i, (text, label) in enumerate(licenses.NOTICES)]
    tokens = [(i, word) for i, _, words in notices for word in sorted(set(words))]
    sizes = [(i, label, licenses.width(len(words)), len(set(words))) for i, label, words in notices]
    return rf"""
WITH tokens AS (SELECT * FROM {_values(tokens)} t(notice, word)),
notices AS (SELECT * FROM {_values(sizes)} t(notice, label, width, size)),
phrases AS (SELECT string_split(phrase, ' ') AS p, label FROM {_values(licenses.PHRASES)} t(phrase, label)),
split AS (
  SELECT doc_id, list_filter(str_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM split),
base AS (
  SELECT doc_id, label, i FROM split, phrases, unnest(range(len(w) - len(p) + 1)) AS u(i) WHERE w[i + 1] = p[1] AND w[i + 1:i + len(p)] = p),
hits AS (SELECT doc_id, notice, word, i // width AS k FROM words JOIN tokens USING (word) JOIN notices USING (notice)),
met AS (
  SELECT doc_id, notice, k, count(DISTINCT word) AS shared
  FROM (SELECT * FROM hits UNION ALL SELECT doc_id, notice, word, k - 1 FROM hits WHERE k > 0) GROUP BY ALL),
enough AS (SELECT doc_id, label, shared / size AS share FROM met JOIN notices USING (notice) WHERE 100 * shared >= {percent} * size),
every AS (SELECT doc_id, label FROM base UNION SELECT doc_id, label FROM enough)
SELECT doc_id, len(w) AS n_words, (SELECT count(*) FROM base b WHERE b.doc_id = s.doc_id) AS n_base,
  (SELECT min(i) FROM base b WHERE b.doc_id = s.doc_id) AS first_word, (SELECT max(i) FROM base b WHERE b.doc_id = s.doc_id) AS last_word,
  coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM base b WHERE b.doc_id = s.doc_id), '') AS base_labels,
  coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM every e WHERE e.doc_id = s.doc_id), '') AS labels,
  CASE WHEN EXISTS (SELECT 1 FROM base b WHERE b.doc_id = s.doc_id) THEN 1.0::DOUBLE
    ELSE coalesce((SELECT max(share) FROM enough e WHERE e.doc_id = s.doc_id), 0.0)::DOUBLE END AS score
FROM split s"""


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_sharding", sql=SHARDS)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.byte_shards(common.table(spark, folder, "documents"), shards=40)


@query("op2_grid_order_join", sql=VECTORS)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return grid_join.near_vectors(common.table(spark, folder, "embeddings"), least=0.95)


@query("op3_secrets")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.secrets(common.table(spark, folder, "documents"))
    spelled = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    base = "filter(spans, s -> s.kind <> 'novel')"
    return found.select(
        "doc_id",
        *(F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}") for kind in secrets.KINDS),
        F.expr(f"sha2({spelled.format(base)}, 256)").alias("base_sha256"),
        F.expr(spelled.format("spans")).alias("spans"),
    )


@query("op4_line_dedup", sql=LINE_DEDUP)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = lines.deduplicate_lines(common.table(spark, folder, "documents"), percent=80)
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


@query("op5_byte_bpe")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(common.table(spark, folder, "documents"), *bpe.public_tokenizer(), output="digests", keep=["doc_id"])


@query("op6_token_counts")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.table(spark, folder, "documents").select("doc_id", "text")
    counted = edits.count_edited(docs, edits.sample_edits(), *bpe.public_tokenizer(), keep=["doc_id"], leaves=False)
    return counted.select("doc_id", "n_tokens", "n_pieces", "n_tokens_before", "n_edits", "n_recounted")


@query("op7_language_id")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.table(spark, folder, "documents")
    model = language.fit(docs.where(~language.held_out()))
    return language.identify(docs, model, keep=["doc_id"]).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query("op8_decontamination")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.table(spark, folder, "documents").select("doc_id", "text")
    found = benchmark.contamination(docs, common.table(spark, folder, "benchmark"), percent=80)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@query("op9_main_text")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.main_text(common.table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query("op10_minhash_forest", sql=NEAR)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(common.table(spark, folder, "documents"), words=4, percent=80)


@query("op11_license_scan", sql=_license_notices())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.summary(licenses.licenses(common.table(spark, folder, "documents"), keep=["doc_id"]))


@query("op12_spelling_variants", sql=SPELLINGS)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    found = spellings.variants(common.table(spark, folder, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query("op13_vector_codes", sql=_vector_codes())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return codes.compress(common.table(spark, folder, "embeddings")).drop("label")
