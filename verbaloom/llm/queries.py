"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbaloom.llm import (
    chat,
    collocations,
    decontamination,
    divergence,
    hilbert_shards,
    id_files,
    jaccard_join,
    packing,
    pii,
    quality_rules,
    sentencepieces,
    token_counts,
    url_filters,
)
from verbaloom.llm.common import read_table, vocabulary_path
from verbaloom.sources.tables import new_path, stage

BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
WORD_VOCABULARY = "word_bpe_49k.json"
SHARDS = 24
# The url rules, and the first labels of listed hosts.
URL_RULES = [
    url_filters.Rule("block", "net", "/"),
    url_filters.Rule("allow", "example.net", "/en/"),
    url_filters.Rule("block", "example.com", "/de/"),
    url_filters.Rule("allow", "org", "/fr/"),
]
LISTED_NAMES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def q_op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(
        _documents(spark, sf_dir), vocabulary_path(BYTE_VOCABULARY), limit=1024
    )
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def q_op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts look like a template."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    mark = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", mark), (-7, 1, "assistant", mark)], turns.schema)
    events = chat.as_events(turns.unionByName(more))
    made = chat.render(chat.fold_events(events))
    told = made.withColumns(
        {"turns": chat.parse(F.col("formatted")), "learned": chat.learned_text(F.col("segments"))}
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return told.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def q_op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sentencepieces.encode_texts(
        _documents(spark, sf_dir), vocabulary_path(PIECE_MODEL), decode=True
    )
    ids = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return made.select(
        "doc_id",
        F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def q_op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaked benchmark items of every document that has some."""
    benchmark = read_table(spark, sf_dir, "benchmark")
    found = decontamination.leaking_pairs(_documents(spark, sf_dir), benchmark)
    return found.select(
        "doc_id",
        "item_id",
        F.round("coverage", 6).alias("coverage"),
        F.col("matched").cast("bigint").alias("matched"),
        F.col("tiles").cast("bigint").alias("tiles"),
    )


def q_op5_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    path = new_path(spark, "id-files")
    id_files.write_ids(docs, path, vocabulary_path(BYTE_VOCABULARY), end_id=2)
    keys = docs.select("doc_id").distinct()
    places = id_files.look_up(spark, path, keys).unionByName(
        id_files.keyless(spark, path), allowMissingColumns=True
    )
    found = id_files.read_ids(spark, path, places)
    return found.select(
        F.col("key").alias("doc_id"),
        "start",
        F.col("n_ids").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def q_op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_pii(_documents(spark, sf_dir))

    def listed(spans):
        one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(one, ",")

    base = F.filter("pii", lambda s: s["base"])

    def number(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("pii")).alias("spans"),
        (F.size("pii") - F.size(base)).cast("bigint").alias("n_added"),
    )


def q_op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class and number of links at a similarity of 0.8."""
    return jaccard_join.similar_documents(_documents(spark, sf_dir), threshold=0.8)


def quality_verdicts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with statistics and the verdict of rules fitted on the labelled documents."""
    labels = read_table(spark, sf_dir, "labels")
    rules = quality_rules.fit_rules(quality_rules.labelled_statistics(docs, labels))
    return quality_rules.with_verdict(quality_rules.with_statistics(docs), rules)


def q_op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_verdicts(spark, _documents(spark, sf_dir), sf_dir)
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "rule")


def q_op9_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    facts = read_table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        "source",
        "lang",
    )
    placed = hilbert_shards.assign_shards(
        stage(facts, "document-facts"), ["source", "lang", "size"], SHARDS
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "cell",
    )


def q_op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by the rules; other hosts are blocked if the list has them. The list is the
    hosts, with or without a service name before them, that begin with a listed name."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    hosts = stage(pages.select(url_filters.host(F.col("url")).alias("key")).distinct(), "hosts")
    name = F.regexp_extract("key", r"^(?:www\.|m\.|blog\.)?([^.]+)\.", 1)
    cascade = url_filters.build_cascade(hosts.where(name.isin(LISTED_NAMES)), hosts)
    judged = url_filters.judge(pages, URL_RULES, cascade)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def q_op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What tells each source from the others of its language, over all documents."""
    docs = read_table(spark, sf_dir, "documents").select("text", "lang", "source")
    found = divergence.divergence(docs)
    return found.select("lang", "source", "part", "item", "value", "rank")


def q_op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 phrases of each language that hold together best, over all documents."""
    docs = read_table(spark, sf_dir, "documents").select("text", "lang")
    return collocations.collocations(docs)


def q_op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document, with its place in a sequence of at most 2048 tokens."""
    packed = packing.packed_pieces(
        _documents(spark, sf_dir), vocabulary_path(WORD_VOCABULARY), end_id=0
    )
    return packed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "sequence_id",
        "offset",
    )


def queries() -> dict:
    return {
        name.removeprefix("q_"): function
        for name, function in globals().items()
        if name.startswith("q_")
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_chat_format": OP2_SQL,
        "op7_jaccard_join": OP7_SQL,
        "op10_url_filters": OP10_SQL,
        "op11_source_divergence": OP11_SQL,
        "op12_phrase_collocations": OP12_SQL,
    }


OP2_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL VALUES
        (-7, 0, 'user', '</s>[INST] ok [/INST]'),
        (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
        AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(
        string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(13 + length(role || text)
        + length(regexp_replace(role || text, '[^\\<\[|]', '', 'g')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

# Words are joined by a space in a shingle; a text of fewer than five words is one shingle.
OP7_SQL = r"""
WITH RECURSIVE cut AS MATERIALIZED (
    SELECT doc_id,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\t-\r ]+'), lambda x: x <> '') AS w
    FROM documents
), kinds AS MATERIALIZED (
    SELECT w, min(doc_id) AS k, count(*) AS copies FROM cut GROUP BY w
), sets AS MATERIALIZED (
    SELECT DISTINCT k, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
        lambda i: array_to_string(w[i:i + 4], ' '))) AS s
    FROM kinds WHERE len(w) > 0
), sizes AS MATERIALIZED (
    SELECT k, count(*) AS n FROM sets GROUP BY k
), common AS MATERIALIZED (
    SELECT a.k AS x, b.k AS y, count(*) AS m
    FROM sets a JOIN sets b ON a.s = b.s AND a.k <> b.k GROUP BY ALL
), links AS MATERIALIZED (
    SELECT x, y FROM common JOIN sizes p ON p.k = x JOIN sizes q ON q.k = y
    WHERE 10 * m >= 8 * (p.n + q.n - m)
), reached(k, r) AS (
    SELECT k, k FROM kinds
    UNION
    SELECT links.y, reached.r FROM reached JOIN links ON links.x = reached.k
), roots AS MATERIALIZED (
    SELECT k, min(r) AS class_id FROM reached GROUP BY k
), degrees AS MATERIALIZED (
    SELECT x AS k, count(*) AS n_texts, sum(copies) AS n_docs
    FROM links JOIN kinds ON kinds.k = links.y GROUP BY x
)
SELECT doc_id, class_id,
    (copies - 1 + coalesce(n_docs, 0))::BIGINT AS n_links,
    coalesce(n_texts, 0)::BIGINT AS n_text_links
FROM cut JOIN kinds USING (w) JOIN roots USING (k) LEFT JOIN degrees USING (k)
"""

OP10_SQL = r"""
WITH parts AS (
    SELECT page_id,
        CASE WHEN contains(url, '://')
            THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
    FROM pages
), cut AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
), ruled AS (
    SELECT *, '.' || host AS h,
        regexp_extract(host, '^(?:www\.|m\.|blog\.)?([^.]+)\.', 1) AS name
    FROM cut
), judged AS (
    SELECT page_id, host, path, name,
        CASE WHEN ends_with(h, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN ends_with(h, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN ends_with(h, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN ends_with(h, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM ruled
)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
        WHEN rule IS NOT NULL THEN 'allow'
        WHEN name IN ('ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets',
            'spam-farm') THEN 'block'
        ELSE 'allow' END AS verdict
FROM judged
"""

OP11_SQL = r"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), found AS (
    SELECT r, lang, source,
        unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs
), counted AS MATERIALIZED (
    SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM found GROUP BY ALL
), kept AS MATERIALIZED (
    SELECT lang, term, sum(n) AS all_n FROM counted GROUP BY lang, term HAVING sum(docs) >= 30
), used AS MATERIALIZED (
    SELECT lang, source, term, n, all_n FROM counted JOIN kept USING (lang, term)
), grouped AS MATERIALIZED (
    SELECT g.lang, g.source, coalesce(u.total, 0) AS total, coalesce(l.total, 0) AS lang_total,
        coalesce(l.v, 0) AS v
    FROM (SELECT DISTINCT lang, source FROM docs) g
    LEFT JOIN (SELECT lang, source, sum(n) AS total FROM used GROUP BY ALL) u USING (lang, source)
    LEFT JOIN (SELECT lang, sum(all_n) AS total, count(*) AS v FROM kept GROUP BY ALL) l USING (lang)
), priced AS MATERIALIZED (
    SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n,
        1 + 1000000000::HUGEINT * (coalesce(n, 0) + 5) // (total + 5 * v) AS p,
        1 + 1000000000::HUGEINT * (kept.all_n + 5) // (lang_total + 5 * v) AS q
    FROM grouped g JOIN kept USING (lang) LEFT JOIN used USING (lang, source, term)
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
), items AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value
    FROM grouped a JOIN grouped b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM priced WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (
        PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM items
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""

OP12_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\n\x0B\f\r]')) AS piece
    FROM documents
), cut AS MATERIALIZED (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w
    FROM pieces
), totals AS (
    SELECT lang, sum(len(w)) AS n FROM cut GROUP BY lang
), counted AS MATERIALIZED (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
    FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM cut)
    JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS k) ON i + k - 1 <= len(w)
    GROUP BY ALL HAVING count(*) >= 100
), phrases AS MATERIALIZED (
    SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM counted WHERE k >= 2
), inside AS (
    SELECT lang, array_to_string(w[i:i + j - 1], ' ') AS phrase, max(a) AS longer
    FROM (SELECT *, unnest(range(1, k + 1)) AS i FROM phrases)
    JOIN (SELECT unnest([2, 3, 4]) AS j) ON j < k AND i + j - 1 <= k
    GROUP BY ALL
), halves AS (
    SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS head,
        array_to_string(w[j + 1:], ' ') AS tail
    FROM (SELECT *, unnest(range(1, k)) AS j FROM phrases)
), scored AS (
    SELECT h.lang, h.phrase, h.a, h.j, x.a AS l, y.a AS r, n,
        1000::HUGEINT * h.a * n // (x.a::HUGEINT * y.a) AS score
    FROM halves h JOIN totals USING (lang)
    JOIN counted x ON x.lang = h.lang AND x.phrase = h.head
    JOIN counted y ON y.lang = h.lang AND y.phrase = h.tail
), lowest AS (
    SELECT * FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), ranked AS (
    SELECT *, row_number() OVER (
        PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR longer < a
)
SELECT lang, rank::INTEGER AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
    n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""
