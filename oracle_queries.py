"""DuckDB SQL for the registered queries, written from the rules and not from the Spark
plans: byte-pair merges are a recursive query, windows are laid out one by one."""

from __future__ import annotations

from spark_queries import LEARNED, LINES_PER_SHARD, RANK_FILE, RECORDS_PER_SHARD, SETTINGS

W, STRIDE, DIM = SETTINGS.window_size, SETTINGS.stride, SETTINGS.dimensions
SHARD, TOP = SETTINGS.tokens_per_shard, SETTINGS.top_n

SPACE = r"[ \t\n\x0B\f\r]"
BREAK = r"\r\n|\n|\r"


def _lines(table="documents", keys="doc_id"):
    return rf"""
doc_lines AS (
  SELECT {keys}, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS line_no
  FROM (SELECT {keys}, CASE WHEN text = '' THEN [] ELSE
          string_split_regex(regexp_replace(text, '({BREAK})\z', ''), '{BREAK}') END AS lines
        FROM {table}))"""


LINES = _lines()

TRIMMED = rf"""
{LINES},
kept AS (
  SELECT doc_id, line_no, regexp_replace(regexp_replace(line, '^[\x00-\x20]+', ''),
         '[\x00-\x20]+$', '') AS line FROM doc_lines),
trimmed AS (SELECT * FROM kept WHERE line <> '')"""

SENTENCES = rf"""
{LINES},
cut AS (
  SELECT doc_id, line_no, list_filter(string_split(
    regexp_replace(line, '([.!?]){SPACE}+', '\1' || chr(1), 'g'), chr(1)),
    lambda x: x <> '') AS parts FROM doc_lines),
sents AS (
  SELECT doc_id, line_no, unnest(parts) AS sentence, generate_subscripts(parts, 1) - 1 AS sentence_no
  FROM cut)"""

CLEAN = rf"""
{SENTENCES},
cleaned AS (
  SELECT doc_id, line_no, sentence_no, lower(trim(regexp_replace(regexp_replace(sentence,
    '[^\w \t\n\x0B\f\r'']', ' ', 'g'), '{SPACE}+', ' ', 'g'))) AS sentence FROM sents),
clean AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no, sentence_no) - 1
    AS sentence_no, row_number() OVER (ORDER BY doc_id, line_no, sentence_no) - 1 AS ordinal,
    sentence FROM cleaned WHERE sentence <> '')"""


def _words(table="documents", keys="doc_id"):
    return rf"""
{_lines(table, keys)},
line_words AS (
  SELECT {keys}, line_no, unnest(parts) AS word, generate_subscripts(parts, 1) AS i
  FROM (SELECT {keys}, line_no, list_filter(string_split_regex(line, '{SPACE}+'),
          lambda x: x <> '') AS parts FROM doc_lines)),
placed AS (
  SELECT {keys}, line_no, word,
    row_number() OVER (PARTITION BY {keys} ORDER BY line_no, i) - 1 AS word_no,
    row_number() OVER (ORDER BY {keys}, line_no, i) - 1 AS position FROM line_words)"""


WORDS = _words()


def _encode(words: str) -> str:
    """Token ids of the words a query gives, by merging the lowest-ranked pair."""
    return rf"""
ranks AS MATERIALIZED (
  SELECT hex(from_base64(split_part(line, ' ', 1))) AS tok,
         CAST(split_part(line, ' ', 2) AS INTEGER) AS rank
  FROM (SELECT unnest(string_split(content, chr(10))) AS line FROM read_text('{RANK_FILE}'))
  WHERE line <> ''),
to_encode AS MATERIALIZED ({words}),
split_words AS (
  SELECT word, regexp_extract_all(word,
    '''s|''t|''re|''ve|''m|''ll|''d|\p{{L}}+|\p{{N}}+|[^\s\p{{L}}\p{{N}}]+') AS pieces
  FROM to_encode),
pieces AS MATERIALIZED (SELECT DISTINCT unnest(pieces) AS piece FROM split_words),
merging(piece, parts) AS (
  SELECT piece, CASE WHEN hex(encode(piece)) IN (SELECT tok FROM ranks) THEN [hex(encode(piece))]
    ELSE regexp_extract_all(hex(encode(piece)), '..') END FROM pieces
  UNION ALL
  SELECT piece, list_concat(parts[1:i-1], [parts[i] || parts[i+1]], parts[i+2:]) FROM (
    SELECT piece, parts, arg_min(i, CAST(rank AS BIGINT) * 100000 + i) AS i FROM (
      SELECT piece, parts, unnest(range(1, len(parts))) AS i FROM merging) x
    JOIN ranks r ON r.tok = parts[i] || parts[i+1]
    GROUP BY piece, parts)),
merged AS (SELECT piece, arg_min(parts, len(parts)) AS parts FROM merging GROUP BY piece),
piece_ids AS MATERIALIZED (
  SELECT piece, list(rank ORDER BY i) AS ids FROM (
    SELECT piece, unnest(parts) AS tok, generate_subscripts(parts, 1) AS i FROM merged)
  JOIN ranks USING (tok) GROUP BY piece),
word_ids AS MATERIALIZED (
  SELECT word, flatten(list(ids ORDER BY k)) AS token_ids FROM (
    SELECT word, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS k FROM split_words)
  JOIN piece_ids USING (piece) GROUP BY word)"""


ENCODED = f"{WORDS},{_encode('SELECT DISTINCT word FROM placed')}"

STREAM = f"""
{ENCODED},
flat AS (
  SELECT position, unnest(token_ids) AS token_id, generate_subscripts(token_ids, 1) AS k
  FROM placed JOIN word_ids USING (word)),
stream AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY position, k) - 1 AS token_pos, token_id FROM flat)"""


def _shards(size=SHARD):
    return f"""
{STREAM},
shards AS MATERIALIZED (
  SELECT token_pos // {size} + 1 AS shard_id, token_pos % {size} AS p, token_id FROM stream),
sizes AS (SELECT shard_id, count(*) AS n FROM shards GROUP BY shard_id)"""


INDEXED = f"""
{_shards()},
firsts AS (
  SELECT *, min(p) OVER (PARTITION BY shard_id, token_id) AS first_p FROM shards),
indexed AS MATERIALIZED (
  SELECT shard_id, p, token_id,
    dense_rank() OVER (PARTITION BY shard_id ORDER BY first_p) - 1 AS token_index FROM firsts)"""


def _windows(value):
    return f"""
spans AS (
  SELECT shard_id, p, list({value}) OVER (PARTITION BY shard_id ORDER BY p
    ROWS BETWEEN CURRENT ROW AND {W} FOLLOWING) AS span FROM indexed),
windows AS (
  SELECT shard_id, p // {STRIDE} AS sample_idx,
    array_to_string(span[1:{W}], ' ') AS input, array_to_string(span[2:{W + 1}], ' ') AS target
  FROM spans WHERE p % {STRIDE} = 0 AND len(span) = {W + 1})"""


PAIRS = f"""
{_shards()},
steps AS (
  SELECT shard_id, p, n, token_id, lead(token_id) OVER (PARTITION BY shard_id ORDER BY p) AS next_id
  FROM shards JOIN sizes USING (shard_id)),
in_window AS (
  SELECT shard_id, token_id, next_id, n, p - i AS s FROM steps, range(0, {W}) AS r(i)),
pairs AS MATERIALIZED (
  SELECT shard_id, token_id, next_id, count(*) AS n FROM in_window
  WHERE s >= 0 AND s % {STRIDE} = 0 AND s + {W} <= n - 1 GROUP BY ALL)"""

COMPONENTS = f"""
{PAIRS},
valued AS (
  SELECT shard_id, token_id, next_id % {DIM} AS dim,
    greatest(0, ln(n * sum(n) OVER (PARTITION BY shard_id)
      / (sum(n) OVER (PARTITION BY shard_id, token_id)
         * sum(n) OVER (PARTITION BY shard_id, next_id))))
      * (1 - 2 * ((next_id // {DIM}) % 2)) AS x FROM pairs),
vocab AS (
  SELECT DISTINCT shard_id, token_id FROM shards JOIN sizes USING (shard_id) WHERE n > {W}),
sums AS (
  SELECT shard_id, token_id, dim, sum(x) AS x FROM (
    SELECT shard_id, token_id, dim, x FROM valued
    UNION ALL SELECT shard_id, token_id, d AS dim, 0.0 AS x FROM vocab, range(0, {DIM}) AS r(d))
  GROUP BY ALL)"""



def _learned(steps=2):
    """Block power iteration over the pair information, with a Cholesky factor written out."""
    n = range(LEARNED)
    start = ", ".join(f"h{c} / 2147483647::DOUBLE - 0.5 AS v{c}" for c in n)
    mixed = ", ".join(
        f"(token_id::BIGINT * 7919 + {c} * 104729 + 12345) % 2147483647 AS f{c}, "
        f"(f{c} * f{c} + 1103515245) % 2147483647 AS e{c}, "
        f"(e{c} * e{c} + 1103515245) % 2147483647 AS h{c}"
        for c in n
    )
    sums = ", ".join(f"sum(w * v{c}) AS v{c}" for c in n)
    products = ", ".join(f"sum(v{i} * v{j}) AS g{i}{j}" for i in n for j in n if i <= j)
    factor, solved = [], []
    for i in n:
        for j in n[i:]:
            rest = f"g{i}{j}" + "".join(f" - r{k}{i} * r{k}{j}" for k in n[:i])
            factor.append(f"sqrt({rest}) AS r{i}{i}" if i == j else f"({rest}) / r{i}{i} AS r{i}{j}")
        solved.append(f"(v{i}" + "".join(f" - r{k}{i} * u{k}" for k in n[:i]) + f") / r{i}{i} AS u{i}")
    parts = [
        f"""{PAIRS},
vocabulary AS MATERIALIZED (
  SELECT DISTINCT token_id FROM shards JOIN sizes USING (shard_id) WHERE n > {W}),
info AS MATERIALIZED (
  SELECT token_id, next_id, w FROM (
    SELECT *, ln(n * sum(n) OVER () / (sum(n) OVER (PARTITION BY token_id)
      * sum(n) OVER (PARTITION BY next_id))) AS w
    FROM (SELECT token_id, next_id, sum(n)::DOUBLE AS n FROM pairs GROUP BY ALL)) WHERE w > 0),
x0 AS (SELECT token_id, {start} FROM (SELECT token_id, {mixed} FROM vocabulary))"""
    ]
    for s in range(1, steps + 1):
        parts.append(f"""z{s} AS MATERIALIZED (
  SELECT next_id AS token_id, {sums} FROM info JOIN x{s - 1} USING (token_id) GROUP BY next_id),
y{s} AS MATERIALIZED (
  SELECT info.token_id, {sums} FROM info JOIN z{s} z ON z.token_id = info.next_id
  GROUP BY info.token_id),
f{s} AS (SELECT {", ".join(factor)} FROM (SELECT {products} FROM y{s})),
x{s} AS MATERIALIZED (
  SELECT token_id, {", ".join(f"u{c} AS v{c}" for c in n)}
  FROM (SELECT token_id, {", ".join(solved)} FROM y{s}, f{s}))""")
    parts.append(f"learned AS (SELECT * FROM vocabulary LEFT JOIN x{steps} USING (token_id))")
    return ",\n".join(parts)


LEARNED_ROWS = "SELECT token_id, concat_ws(',', {}) AS embedding FROM learned".format(
    ", ".join(f"CAST(round(coalesce(v{c}, 0) * 1e6) AS BIGINT)" for c in range(LEARNED))
)

DECODED = """
raw_words AS (
  SELECT rank AS token_id, tok, TRY(decode(unhex(tok))) AS valid FROM ranks),
decoded AS (
  SELECT token_id, coalesce(valid, CASE
    -- Bytes that are no whole character: one U+FFFD per byte, or per cut-off sequence.
    WHEN regexp_full_match(tok, '[CD].|E.[89AB].|F.[89AB].[89AB].|E.|F.|F.[89AB].') THEN chr(65533)
    ELSE repeat(chr(65533), CAST(length(tok) // 2 AS INTEGER)) END) AS word FROM raw_words)"""

MEANS = f"""
{COMPONENTS},
{DECODED},
means AS MATERIALIZED (SELECT token_id, dim, avg(x) AS x FROM sums GROUP BY ALL)"""

VECTORS = """
vecs AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
lengths AS MATERIALIZED (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM vecs)"""

LABEL_MEANS = f"""
{VECTORS},
elements AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM vecs),
label_means AS (
  SELECT label, list(x ORDER BY d) AS m FROM (
    SELECT label, d, avg(x) AS x FROM elements GROUP BY ALL) GROUP BY label)"""

MILLIONTHS = "string_agg(CAST(CAST(round(x * 1e6) AS BIGINT) AS VARCHAR), ',' ORDER BY dim)"


def _millionths(vector):
    return (
        f"array_to_string(list_transform({vector}, "
        "lambda x: CAST(round(x * 1e6) AS BIGINT)), ',')"
    )


def _six(x):
    return f"round({x}, 6) + 0.0"


def _top(vectors, word):
    """Ranked neighbours of another word, from a table (id, word, v, norm)."""
    return f"""
compared AS (
  SELECT a.id, a.{word}, b.id AS neighbour_id, b.{word} AS neighbour,
    CASE WHEN a.norm <> 0 AND b.norm <> 0
      THEN list_inner_product(a.v, b.v) / (a.norm * b.norm) ELSE 0.0 END AS similarity
  FROM {vectors} a JOIN {vectors} b ON a.{word} <> b.{word}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id
    ORDER BY round(similarity, 10) DESC, neighbour, neighbour_id) AS rank FROM compared
  QUALIFY rank <= {TOP})"""



def _named(word):
    return f"""{VECTORS},
named AS (SELECT vec_id AS id, CAST({word} AS VARCHAR) AS word, v, norm FROM lengths)"""


FILE_LINES = f"""
{CLEAN},
files AS (
  SELECT ordinal // {RECORDS_PER_SHARD} + 1 AS shard_id, ordinal, sentence FROM clean)"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "lines": (LINES, "SELECT doc_id, line_no, line FROM doc_lines"),
        "trim_lines": (TRIMMED, "SELECT doc_id, line_no, line FROM trimmed"),
        "sentences": (SENTENCES, "SELECT doc_id, line_no, sentence_no, sentence FROM sents"),
        "clean_sentences": (CLEAN, "SELECT doc_id, sentence_no, sentence FROM clean"),
        "split_words": (WORDS, "SELECT doc_id, word_no, word FROM placed"),
        "extract_words": (
            f"""{LINES}, found AS (
  SELECT doc_id, line_no, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM (
    SELECT doc_id, line_no, regexp_extract_all(line, '[a-zA-Z0-9'']+') AS w FROM doc_lines))""",
            "SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no, i) - 1 "
            "AS word_no, word FROM found",
        ),
        "word_counts": (
            f"""{LINES}, found AS (
  SELECT unnest(regexp_extract_all(line, '[a-zA-Z0-9'']+')) AS word FROM doc_lines)""",
            "SELECT word, count(*) AS n FROM found GROUP BY word",
        ),
        "parse_positioned": (
            WORDS,
            """SELECT doc_id, 0 AS form, word_no AS position, word FROM placed
UNION ALL SELECT doc_id, 1, word_no, word || '_' || word FROM placed""",
        ),
        "positioned_words": (WORDS, "SELECT doc_id, position, word FROM placed"),
        "conversation_positions": (
            _words("conversations", "conv_id, turn"),
            "SELECT conv_id, turn, position, word FROM placed",
        ),
        "sentence_shards": (FILE_LINES, "SELECT shard_id, ordinal, sentence FROM files"),
        "line_shards": (
            f"""{TRIMMED}, numbered AS (
  SELECT row_number() OVER (ORDER BY doc_id, line_no) - 1 AS ordinal, line FROM trimmed)""",
            f"SELECT ordinal // {RECORDS_PER_SHARD} + 1 AS shard_id, ordinal, line FROM numbered",
        ),
        "word_shards": (
            f"""{WORDS}, line_ordinals AS (
  SELECT doc_id, line_no, row_number() OVER (ORDER BY doc_id, line_no) - 1 AS n FROM doc_lines)""",
            f"SELECT n // {LINES_PER_SHARD} AS shard_id, position, word FROM placed "
            "JOIN line_ordinals USING (doc_id, line_no)",
        ),
        "position_buckets": (
            f"{WORDS}, width AS (SELECT CAST(ceil(max(position) / 4) AS BIGINT) AS size FROM placed)",
            "SELECT position, least(position // size, 3) AS bucket FROM placed, width",
        ),
        "bucket_files": (
            f"{WORDS}, width AS (SELECT CAST(ceil(max(position) / 4) AS BIGINT) AS size FROM placed)",
            """SELECT CAST(least(position // size, 3) AS INTEGER) AS bucket, count(*) AS n,
  min(position) AS first_position, max(position) AS last_position,
  arg_min(word, position) AS first_word, arg_max(word, position) AS last_word
FROM placed, width GROUP BY 1""",
        ),
        "shard_ranges": (FILE_LINES, "SELECT shard_id, ordinal, sentence FROM files"),
        "max_position": (WORDS, "SELECT max(position) AS max_position FROM placed"),
        "word_token_counts": (
            f"""{CLEAN}, found AS (
  SELECT unnest(regexp_extract_all(sentence, '[a-zA-Z0-9'']+')) AS word FROM clean),
counted AS (SELECT word, count(*) AS n FROM found GROUP BY word),
{_encode('SELECT word FROM counted')}""",
            "SELECT word, array_to_string(token_ids, ' ') AS token_ids, n "
            "FROM counted JOIN word_ids USING (word)",
        ),
        "tokenized_words": (
            ENCODED,
            "SELECT position, word, array_to_string(token_ids, ' ') AS token_ids "
            "FROM placed JOIN word_ids USING (word)",
        ),
        "format_tokenized": (
            ENCODED,
            "SELECT position || '_' || word || chr(9) || '[' || array_to_string(token_ids, ' ') "
            "|| ']' AS line FROM placed JOIN word_ids USING (word)",
        ),
        "token_stream": (STREAM, "SELECT token_pos, token_id FROM stream"),
        "token_shards": (_shards(), "SELECT shard_id, p AS token_pos, token_id FROM shards"),
        "decode_tokens": (
            f"{STREAM}, {DECODED}",
            "SELECT token_id, word, count(*) AS n FROM stream JOIN decoded USING (token_id) "
            "GROUP BY ALL",
        ),
        "shard_vocab": (INDEXED, "SELECT DISTINCT shard_id, token_index, token_id FROM indexed"),
        "indexed_tokens": (
            INDEXED,
            "SELECT shard_id, p AS token_pos, token_id, token_index FROM indexed",
        ),
        "window_pairs": (f"{INDEXED}, {_windows('token_id')}", "SELECT * FROM windows"),
        "corpus_windows": (
            STREAM,
            f"""SELECT s // {STRIDE} AS sample_idx,
  string_agg(CAST(token_id AS VARCHAR), ' ' ORDER BY i) FILTER (i < {W}) AS input,
  string_agg(CAST(token_id AS VARCHAR), ' ' ORDER BY i) FILTER (i > 0) AS target
FROM (SELECT token_pos - i AS s, i, token_id FROM stream, range(0, {W} + 1) AS r(i))
WHERE s >= 0 AND s % {STRIDE} = 0 AND s + {W} <= (SELECT max(token_pos) FROM stream) GROUP BY s""",
        ),
        "training_table": (f"{INDEXED}, {_windows('token_index')}", "SELECT * FROM windows"),
        "trainable_shards": (
            _shards(9),
            f"SELECT shard_id, n AS n_tokens FROM sizes WHERE n >= {W + 1}",
        ),
        "pair_counts": (PAIRS, "SELECT shard_id, token_id, next_id, n FROM pairs"),
        "shard_embeddings": (
            COMPONENTS,
            f"SELECT shard_id, token_id, {MILLIONTHS} AS embedding FROM sums GROUP BY ALL",
        ),
        "token_embeddings": (
            MEANS,
            f"SELECT token_id, word, {MILLIONTHS} AS embedding FROM means "
            "JOIN decoded USING (token_id) GROUP BY ALL",
        ),
        "mean_embeddings": (
            LABEL_MEANS,
            f"SELECT label, {_millionths('m')} AS embedding FROM label_means",
        ),
        "vector_norms": (VECTORS, f"SELECT vec_id, {_six('norm')} AS norm FROM lengths"),
        "dot_products": (
            VECTORS,
            f"SELECT a.vec_id, {_six('list_inner_product(a.v, b.v)')} AS dot "
            "FROM vecs a JOIN vecs b ON b.vec_id = a.vec_id + 1",
        ),
        "cosine_pairs": (
            f"""{LABEL_MEANS}, both_sides AS (
  SELECT vec_id, label, norm, list_inner_product(v, m) AS dot,
    sqrt(list_inner_product(m, m)) AS mean_norm FROM lengths JOIN label_means USING (label))""",
            f"SELECT vec_id, label, {_six('dot')} AS dot, CASE WHEN norm <> 0 AND mean_norm <> 0 "
            f"THEN {_six('dot / (norm * mean_norm)')} ELSE 0.0 END AS cosine FROM both_sides",
        ),
        "cosine_topn": (
            f"{_named('vec_id')}, {_top('named', 'word')}",
            f"SELECT id AS vec_id, rank, neighbour_id, {_six('similarity')} AS similarity FROM ranked",
        ),
        "neighbours": (
            f"{_named('label')}, {_top('named', 'word')}",
            """SELECT n.id AS vec_id, n.word, coalesce(string_agg(
  CAST(neighbour_id AS VARCHAR), ' ' ORDER BY rank), '') AS ids
FROM named n LEFT JOIN ranked r ON r.id = n.id GROUP BY ALL""",
        ),
        "dedupe_last": (
            f"{VECTORS}, last AS (SELECT label, max(vec_id) AS vec_id FROM vecs GROUP BY label)",
            f"SELECT label, vec_id, {_millionths('v')} AS embedding "
            "FROM last JOIN vecs USING (label, vec_id)",
        ),
        "learned_vectors": (_learned(), LEARNED_ROWS),
        "word2vec_vectors": (
            _shards(),
            "SELECT DISTINCT token_id, 16 AS length, true AS is_finite "
            f"FROM shards JOIN sizes USING (shard_id) WHERE n >= {W + 1}",
        ),
        "neighbour_lines": (
            f"""{VECTORS}, named AS (
  SELECT vec_id AS id, 'v' || vec_id AS word, v, norm FROM lengths), {_top('named', 'word')},
lists AS (SELECT id, string_agg(neighbour, ' ' ORDER BY rank) AS found FROM ranked GROUP BY id)""",
            f"SELECT word, {_millionths('v')} AS embedding, coalesce(found, '') AS neighbours "
            "FROM named LEFT JOIN lists USING (id)",
        ),
        "nearest_words": (
            f"""{MEANS},
lists AS (
  SELECT token_id AS id, list(x ORDER BY dim) AS v FROM means GROUP BY token_id),
named AS MATERIALIZED (
  SELECT id, word, v, sqrt(list_inner_product(v, v)) AS norm
  FROM lists JOIN decoded ON token_id = id), {_top('named', 'word')}""",
            f"SELECT id AS token_id, word, rank, neighbour_id, neighbour, {_six('similarity')} "
            "AS similarity FROM ranked",
        ),
        "whole_files": (
            f"""{FILE_LINES}, whole AS (
  SELECT shard_id, string_agg(sentence, chr(10) ORDER BY ordinal) || chr(10) AS content
  FROM files GROUP BY shard_id)""",
            "SELECT shard_id, length(content) AS n_chars, md5(content) AS md5 FROM whole",
        ),
        "numbered_lines": (FILE_LINES, "SELECT ordinal AS line_no, sentence AS line FROM files"),
        "line_word_shards": (
            f"""{FILE_LINES}, file_words AS (
  SELECT ordinal, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM (
    SELECT ordinal, string_split(sentence, ' ') AS w FROM files))""",
            "SELECT ordinal // 500 AS shard_id, row_number() OVER (ORDER BY ordinal, i) - 1 "
            "AS position, word FROM file_words",
        ),
        "find_file": (
            FILE_LINES,
            "SELECT count(*) AS n_lines FROM files WHERE shard_id = 1",
        ),
        "import_embeddings": (
            VECTORS,
            "SELECT 'v' || vec_id || ' ' || label AS key, 'v' || vec_id AS word, "
            f"{_millionths('v')} AS embedding FROM vecs WHERE label > 3",
        ),
        "rejected_embeddings": (
            VECTORS,
            "SELECT 'v' || vec_id || ' ' || label AS key FROM vecs WHERE label <= 3",
        ),
    }
    sql["text_shards"] = sql["word_shards"]
    sql["written_nearest_words"] = sql["nearest_words"]
    sql["imported_token_shards"] = sql["token_shards"]
    sql["imported_neighbours"] = (
        f"""{VECTORS}, named AS (
  SELECT 'v' || vec_id || ' ' || label AS id, 'v' || vec_id AS word, v, norm
  FROM lengths), {_top('named', 'word')}""",
        f"SELECT id AS key, rank, neighbour, {_six('similarity')} AS similarity FROM ranked",
    )
    sql["imported_neighbours_by_word"] = (
        f"""{VECTORS}, named AS (
  SELECT vec_id AS id, CAST(label AS VARCHAR) AS word, v, norm FROM lengths
  QUALIFY vec_id = max(vec_id) OVER (PARTITION BY label)), {_top('named', 'word')}""",
        f"SELECT word, rank, neighbour, {_six('similarity')} AS similarity FROM ranked",
    )
    sql["parse_tokenized"] = sql["tokenized_words"]
    ctes, body = sql["line_shards"]
    sql["overwritten_shards"] = (ctes, f"SELECT shard_id, line FROM ({body})")
    return {name: f"WITH RECURSIVE {ctes.strip()}\n{body}" for name, (ctes, body) in sql.items()}
