"""The four chains: corpus to counts, to token shards, to vectors, to nearest words."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbaloom.operators import embeddings, encoding, similarity, words
from verbaloom.operators.encoding import Vocabulary
from verbaloom.operators.shards import STRIDE, WINDOW_SIZE
from verbaloom.sources.tables import scope, stage, stage_keyed


@dataclass(frozen=True)
class Settings:
    """The defaults of every chain."""

    window_size: int = WINDOW_SIZE
    stride: int = STRIDE
    dimensions: int = embeddings.DIMENSIONS
    top_n: int = similarity.TOP_N
    tokens_per_shard: int = 30_000


def word_token_counts(df: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """word, token_ids, n over the cleaned sentences of a corpus."""
    return encoding.encode_counts(words.word_counts(df, text, lower=True), vocabulary)


def encoded_corpus(
    df: DataFrame, keys: list[str], vocabulary: Vocabulary, text: str = "text"
) -> DataFrame:
    """keys, words, word_ids, n_words as a staged table in buckets of the keys: encoding is
    done once, and whatever is derived from it reads only the columns it needs.

    Texts move to their buckets and are encoded there: words and ids are several times as wide."""

    def encoded(placed):
        words = encoding.encode_texts(placed, keys, vocabulary, text)
        return words.withColumn("n_words", F.size("words").cast("bigint"))

    return stage_keyed(df.select(*keys, text), "encoded", keys, encoded)


def corpus_tokens(
    df: DataFrame, keys: list[str], vocabulary: Vocabulary, text: str = "text"
) -> DataFrame:
    """keys, tokens, n_tokens as such a table: without the words, for the token stream."""
    return stage_keyed(
        df.select(*keys, text), "tokens", keys, lambda placed: counted_tokens(placed, keys, vocabulary, text)
    )


def counted_tokens(
    df: DataFrame, keys: list[str], vocabulary: Vocabulary, text: str = "text"
) -> DataFrame:
    """keys, tokens, n_tokens."""
    encoded = encoding.encode_tokens(df, keys, vocabulary, text)
    return encoded.withColumn("n_tokens", F.size("tokens").cast("bigint"))


def token_vectors(
    texts: DataFrame, keys: list[str], vocabulary: Vocabulary, settings: Settings = Settings()
) -> DataFrame:
    """token_id, embedding, word from keys, tokens: each token's vector averaged over the
    token shards."""
    shards = encoding.token_shards(texts, keys, settings.tokens_per_shard)
    mean = embeddings.average_shard_embeddings(
        shards, settings.dimensions, settings.window_size, settings.stride
    )
    return embeddings.with_words(mean, vocabulary)


def nearest_words(
    df: DataFrame,
    keys: list[str],
    vocabulary: Vocabulary,
    settings: Settings = Settings(),
    text: str = "text",
) -> DataFrame:
    """token_id, word, rank, neighbour_id, neighbour, similarity, from raw text."""
    texts = corpus_tokens(df, keys, vocabulary, text)
    vectors = stage(token_vectors(texts, keys, vocabulary, settings), "vectors")
    return similarity.top_neighbours(vectors, "token_id", "word", settings.top_n)


def write_token_vectors(
    df: DataFrame,
    keys: list[str],
    vocabulary: Vocabulary,
    path: str,
    settings: Settings = Settings(),
    text: str = "text",
) -> None:
    """Write ``token_vectors`` of a corpus to ``path``; see ``write_nearest_words``."""
    spark = df.sparkSession
    with scope(spark, f"{path}.steps") as job:
        texts = job.step("tokens", lambda: counted_tokens(df, keys, vocabulary, text))
        found = token_vectors(texts, keys, vocabulary, settings)
        found.write.mode("overwrite").parquet(path)


def write_nearest_words(
    df: DataFrame,
    keys: list[str],
    vocabulary: Vocabulary,
    path: str,
    settings: Settings = Settings(),
    text: str = "text",
) -> None:
    """Write ``nearest_words`` of a corpus to ``path``, in steps that outlive a failure.

    Ids and vectors are kept in ``path.steps`` as they are finished. A run that fails leaves
    them, and the next one with this path goes on from there, so it must have the same
    input. A run that ends leaves the result and nothing else.
    """
    spark = df.sparkSession
    with scope(spark, f"{path}.steps") as job:
        texts = job.step("tokens", lambda: counted_tokens(df, keys, vocabulary, text))
        vectors = job.step("vectors", lambda: token_vectors(texts, keys, vocabulary, settings))
        found = similarity.top_neighbours(vectors, "token_id", "word", settings.top_n)
        found.write.mode("overwrite").parquet(path)
