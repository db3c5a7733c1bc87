"""The registered queries of the operators, and the SQL to check them with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealtide.llm import (
    chat, decontaminate, langid, licenses, mixing, neardup, phrases, repeats, sharding, topk, toxicity, urls, variants,
)
from dealtide.llm.tables import keep, read, words_in

#: Rows whose id is divisible by this are queries, for searches.
QUERY_STEP = 50
SHARDS = 8

#: Verdict, host and path of the URL rules.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 vectors of highest inner product with every 50th vector."""
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0, k=5)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot, under the law ``rows``."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    documents = read(spark, sf_dir, "documents").select(
        "doc_id", "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return sharding.interleave(documents, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it holds, exactly or with a few edits."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(documents, read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).groupBy("doc_id", "leak.item_id").agg(
        F.count("*").alias("passages"),
        F.min("leak.distance").alias("distance"),
        F.min("leak.start").alias("first_word"),
    )


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document says about licenses."""
    scanned = licenses.scan(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "licenses.*")

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"),
        F.array_max("base.start").alias("last_word"),
        joined(F.col("base.label")).alias("base_labels"),
        joined(F.concat("base.label", "found.label")).alias("labels"),
        "score",
    )


def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents, on shingles of four words."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(documents, size=4, columns=["doc_id"]).select("doc_id", "n_shingles", "component_id", "kept")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all formatted conversations, read back from the formatted texts."""
    said = f"{chat.END}{chat.START}assistant ok"
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.sql(
        "SELECT -1L AS conv_id, turn, role, :said AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)", {"said": said}
    )
    chats = chat.format_chats(given.unionByName(hostile))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        chats.withColumn("turns", chat.read_turns(F.col("formatted")))
        .withColumn("loss", chat.masked(F.col("formatted"), F.col("loss_spans")))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document: weights 5, 2, 1 and 150% of all words."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "source", words_in(F.col("text")).alias("size"))
    documents = keep(documents)  # the texts are read once
    return mixing.mix(documents, "size").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of two thirds of them."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.learn_from_tables(documents, read(spark, sf_dir, "labels"))
    return toxicity.score(documents, lexicon).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "toxicity.score",
        (F.col("toxicity.score") >= 0.7).cast("int").alias("predicted"),
        (F.col("toxicity.pattern") != "").alias("matched"),
    )


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, "url", URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = langid.held_out(F.col("doc_id"))
    identifier = langid.learn(documents.filter(~held_out).select("lang", "text"))
    return langid.identify(documents.select("doc_id", "text"), identifier).select(
        "doc_id", held_out.alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score",
        "language.rejected",
    )


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages of 13 words that an earlier one has."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(documents, size=13).select(
        "doc_id", "repeats.n_words", "repeats.n_removed", F.sha2("repeats.text", 256).alias("kept_sha256")
    )


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest collocations of every language."""
    documents = read(spark, sf_dir, "documents").select("text", "lang")
    return phrases.collocations(documents, threshold=100, longest=5, first=2000)


#: Of so many words one is spoilt, and words of so many letters and occurrences are looked at.
MISSPELT, LEAST_LETTERS, LEAST_COUNT = 199, 6, 5


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, some of them spoilt, with their near words and the form they come from."""
    counted = variants.count_words(read(spark, sf_dir, "documents").select("doc_id", "text"), every=MISSPELT)
    words = counted.filter((F.char_length("word") >= LEAST_LETTERS) & (F.col("n") >= LEAST_COUNT))
    return variants.group_variants(words, ratio=5)


QUERIES = {
    "op1_topk": op1_topk,
    "op3_decontamination": op3_decontamination,
    "op4_licenses": op4_licenses,
    "op2_sharding": op2_sharding,
    "op5_neardup": op5_neardup,
    "op6_chat": op6_chat,
    "op7_mixing": op7_mixing,
    "op8_toxicity": op8_toxicity,
    "op9_urls": op9_urls,
    "op10_langid": op10_langid,
    "op11_repeats": op11_repeats,
    "op12_phrases": op12_phrases,
    "op13_variants": op13_variants,
}

#: CRC-32 in SQL: the table of its polynomial, made by its rule, applied byte by byte.
_CRC_TABLE = """steps AS (
            SELECT i::BIGINT AS i, i::BIGINT AS v, 0 AS k FROM range(256) r(i)
            UNION ALL
            SELECT i, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, k + 1 FROM steps WHERE k < 8
        ), crc_table AS (SELECT list(v ORDER BY i) AS crcs FROM steps WHERE k = 8)"""
_CRC32 = """xor(4294967295, list_reduce(
                   [4294967295::BIGINT] || list_transform(
                       regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT),
                   lambda c, b: xor(c // 256, crcs[xor(c % 256, b) + 1])))"""

#: CRC-32 of the bytes of ``doc_id:word`` for every word.
_CRC32_WORD = _CRC32.replace("coalesce(text, '')", "coalesce(CAST(doc_id AS VARCHAR), '') || ':' || word")

_SOURCE = "coalesce('0' || source, '1')"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _urls_oracle() -> str:
    def hit(term: str) -> str:
        return f"regexp_matches(low, '(^|[^a-z])(?:{term})([^a-z]|$)')"

    weight = " + ".join(f"CASE WHEN {hit(term)} THEN {w} ELSE 0 END" for term, w in urls.SOFT.items())
    rules = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in URL_RULES)
    return f"""
        WITH parts AS (
            SELECT page_id, url, translate(coalesce(url, ''), '{_UPPER}', '{_UPPER.lower()}') AS low,
                   translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{_UPPER}', '{_UPPER.lower()}') AS host,
                   regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
            FROM pages
        ), rules(verdict, base, start) AS (VALUES {rules}),
        ruled AS (
            SELECT p.page_id, p.low, p.host, p.path, arg_max(base || start, length(base || start)) AS rule,
                   arg_max(verdict, length(base || start)) AS ruled
            FROM parts p LEFT JOIN rules r
              ON (p.host = r.base OR ends_with(p.host, '.' || r.base)) AND starts_with(p.path, r.start)
            GROUP BY p.page_id, p.low, p.host, p.path
        )
        SELECT page_id, host, path, rule,
               coalesce(ruled, CASE WHEN {hit("|".join(urls.STRICT))} OR {weight} >= {urls.REJECT}
                        THEN 'block' ELSE 'allow' END) AS verdict
        FROM ruled
    """


ORACLE = {
    "op1_topk": f"""
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM vectors q JOIN vectors c ON q.vec_id % {QUERY_STEP} = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scored QUALIFY rank <= 5
    """,
    "op9_urls": _urls_oracle(),
    "op2_sharding": f"""
        WITH RECURSIVE {_CRC_TABLE}, ranked AS (
            SELECT doc_id, {_CRC32} AS text_crc32, strlen(coalesce(text, '')) + 1 AS size, {_SOURCE} AS source,
                   md5('{sharding.SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
                   row_number() OVER (PARTITION BY source ORDER BY key) AS rank,
                   count(*) OVER (PARTITION BY source) AS n
            FROM documents, crc_table
        ), placed AS (
            SELECT *, row_number() OVER (ORDER BY CAST(2 * rank - 1 AS DOUBLE) / CAST(2 * n AS DOUBLE), source, key) - 1 AS place,
                   count(*) OVER () AS total
            FROM ranked
        ), cut AS (SELECT *, place * {SHARDS} // total AS shard FROM placed)
        SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard,
               row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
        FROM cut
    """,
    "op6_chat": f"""
        WITH RECURSIVE said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '{chat.END}{chat.START}assistant ok'
            UNION ALL SELECT -1, 1, 'assistant', '{chat.END}{chat.START}assistant ok'
        ), marked AS (
            SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS NOT DISTINCT FROM role AS joined,
                   length(text) + length(text) - length(replace(text, '\\', ''))
                   + (length(text) - length(replace(text, '<|', ''))) // 2 AS chars
            FROM said
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(chars + CASE WHEN joined THEN {len(chat.JOIN)}
                   ELSE {len(chat.START) + len(chat.END) + 2} + length(role) END) AS BIGINT) AS formatted_chars
        FROM marked GROUP BY conv_id
    """,
    "op11_repeats": """
        WITH docs AS (
            SELECT row_number() OVER () AS line, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
        ), stretches AS (
            SELECT line, doc_id, k, array_to_string(words[k:k + 12], ' ') AS stretch
            FROM docs, unnest(range(1, greatest(len(words) - 11, 1))) AS t(k)
        ), earliest AS (SELECT stretch, min(doc_id) AS least FROM stretches GROUP BY stretch),
        repeated AS (SELECT line, k FROM stretches JOIN earliest USING (stretch) WHERE least < doc_id OR (doc_id IS NULL AND least IS NOT NULL)),
        gone AS (SELECT DISTINCT line, k + step AS k FROM repeated, range(13) AS r(step)),
        lists AS (SELECT line, list(k) AS gone FROM gone GROUP BY line),
        left_over AS (
            SELECT doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed,
                   list_filter(words, lambda w, i: gone IS NULL OR NOT list_contains(gone, i)) AS kept
            FROM docs LEFT JOIN lists USING (line)
        )
        SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM left_over
    """,
    "op12_phrases": f"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   regexp_extract_all(unnest(regexp_split_to_array(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS words
            FROM documents WHERE text IS NOT NULL
        ), grams AS (
            SELECT lang, size, array_to_string(words[k:k + size - 1], ' ') AS phrase
            FROM pieces, range(1, 6) AS s(size), unnest(range(1, greatest(len(words) - size + 2, 1))) AS t(k)
        ), counted AS (SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY ALL),
        totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM counted WHERE size = 1 GROUP BY lang),
        candidates AS (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS words FROM counted WHERE size >= 2 AND n >= 100),
        cuts AS (
            SELECT c.lang, c.phrase, c.size, a, words, k, l.n AS l, r.n AS r, t.n AS n,
                   CAST(1000::HUGEINT * a * t.n // (l.n::HUGEINT * r.n) AS BIGINT) AS score
            FROM candidates c, unnest(range(1, c.size)) AS u(k), counted l, counted r, totals t
            WHERE l.lang = c.lang AND r.lang = c.lang AND t.lang = c.lang
              AND l.phrase = array_to_string(c.words[1:k], ' ') AND r.phrase = array_to_string(c.words[k + 1:], ' ')
        ), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inside AS (
            SELECT lang, array_to_string(words[k:k + size2 - 1], ' ') AS phrase, max(a) AS longer
            FROM candidates, range(2, 5) AS s(size2), unnest(range(1, greatest(size - size2 + 2, 1))) AS u(k)
            WHERE size2 < size GROUP BY ALL
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "binary") AS rank,
               phrase, a, l, r, n, score
        FROM best LEFT JOIN inside USING (lang, phrase)
        WHERE longer IS NULL OR 100 * longer < 100 * a
        QUALIFY rank <= 2000
    """,
    "op13_variants": f"""
        WITH RECURSIVE {_CRC_TABLE}, runs AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS word
            FROM documents
        ), pairs AS (SELECT doc_id, word, count(*) AS n FROM runs GROUP BY ALL),
        marked AS (SELECT word, n, {_CRC32_WORD} AS h FROM pairs, crc_table),
        spoilt AS (
            SELECT CASE WHEN h % {MISSPELT} = 0 THEN word[:h % length(word)] || word[h % length(word) + 2:] ELSE word END AS word, n FROM marked
        ), words AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spoilt GROUP BY word
            HAVING length(word) >= {LEAST_LETTERS} AND sum(n) >= {LEAST_COUNT}
        ), without AS (
            SELECT word, n, k, CASE WHEN k = 1 THEN word[2:] ELSE word[:k - 1] || word[k + 1:] END AS rest
            FROM words, unnest(range(1, length(word) + 1)) AS t(k)
        ), met AS (
            SELECT a.word AS a, b.word AS b, b.n FROM without a JOIN without b USING (k, rest) WHERE a.word <> b.word
            UNION SELECT w.rest, w.word, w.n FROM without w JOIN words s ON s.word = w.rest
            UNION SELECT w.word, s.word, s.n FROM without w JOIN words s ON s.word = w.rest
        ), near AS (
            SELECT a AS word, count(*) AS n_near, arg_min(b, (-n, b)) AS form, max(n) AS form_n FROM met GROUP BY a
        ), forms AS (
            SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN form_n >= 5 * words.n THEN form END AS form, CASE WHEN form_n >= 5 * words.n THEN form_n END AS form_n
            FROM words LEFT JOIN near USING (word)
        ), chains AS (
            SELECT word, word AS root, form AS next FROM forms
            UNION ALL
            SELECT c.word, f.word, f.form FROM chains c JOIN forms f ON f.word = c.next
        )
        SELECT word, n, form, root, n_near, form_n FROM forms JOIN (SELECT word, root FROM chains WHERE next IS NULL) USING (word)
    """,
    "op7_mixing": f"""
        WITH docs AS (
            SELECT doc_id, {_SOURCE} AS source,
                   coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
                   md5('{mixing.SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
            FROM documents
        ), sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source) - 1) % 3 + 1 AS INTEGER)]::DOUBLE AS weight
            FROM docs GROUP BY source
        ), levels AS (
            SELECT a.source, a.source_size, a.weight, 2.0::DOUBLE * a.source_size AS most,
                   (SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE FROM sources) AS budget,
                   (SELECT coalesce(sum(2 * b.source_size), 0)::DOUBLE FROM sources b
                    WHERE (2.0::DOUBLE * b.source_size / b.weight, b.source) < (2.0::DOUBLE * a.source_size / a.weight, a.source)) AS used,
                   (SELECT sum(b.weight) FROM sources b
                    WHERE (2.0::DOUBLE * b.source_size / b.weight, b.source) >= (2.0::DOUBLE * a.source_size / a.weight, a.source)) AS sharing
            FROM sources a
        ), level AS (
            SELECT min((most / weight, source, (budget - used) / sharing)) AS lowest
            FROM levels WHERE (budget - used) / sharing <= most / weight
        ), targets AS (
            SELECT source, source_size, budget,
                   CASE WHEN (most / weight, source) >= (lowest[1], lowest[2]) THEN least(most, lowest[3] * weight) ELSE most END AS target
            FROM levels, level
        ), served AS (
            SELECT docs.*, source_size, target, budget,
                   sum(size) OVER (PARTITION BY source ORDER BY key ROWS UNBOUNDED PRECEDING) AS served
            FROM docs JOIN targets USING (source)
        ), queue AS (
            SELECT doc_id, source, key, size, budget, turn,
                   (turn * source_size + served)::DOUBLE / target AS finish, served
            FROM served, (VALUES (0), (1)) AS t(turn) WHERE size > 0
        ), line AS (
            SELECT doc_id, size, sum(size) OVER (ORDER BY finish, source, key, served, turn ROWS UNBOUNDED PRECEDING) <= budget AS taken
            FROM queue
        ), taken AS (SELECT doc_id, CAST(sum(size) FILTER (taken) AS BIGINT) AS taken FROM line GROUP BY doc_id)
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, coalesce(taken.taken, 0) AS taken
        FROM served LEFT JOIN taken USING (doc_id)
    """,
}
