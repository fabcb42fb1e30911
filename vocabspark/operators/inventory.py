"""Token inventories (special, buffer, whitespace, fallback), budget, roles and usage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabspark.operators.matching import segments

# --- fixed values ---------------------------------------------------------------------
SPECIAL_TOKENS = [
    "<|sep|>", "<|s|>", "<|/s|>", "<|pad|>", "<|bos|>", "<|eos|>", "<|endoftext|>",
    "<|fim_prefix|>", "<|fim_suffix|>", "<|fim_middle|>", "<|translate|>", "<|startofprompt|>",
    "<|endofprompt|>", "<|user|>", "<|assistant|>", "<|system|>", "<|meta|>", "<|meta_start|>",
    "<|meta_end|>", "<|mask|>", "<|mask1|>", "<|cls|>", "<|cls_vision|>", "<|cls_audio|>",
    "<|tel_start|>", "<|tel_end|>", "<|rrn_start|>", "<|rrn_end|>", "<|url_start|>",
    "<|url_end|>", "<|email_start|>", "<|email_end|>", "<|crd_start|>", "<|crd_end|>",
    "<|acc_start|>", "<|acc_end|>", "<|name_start|>", "<|name_end|>", "<|org_start|>",
    "<|org_end|>", "<|sos|>", "<|unk|>",
]
UNKNOWN_TOKEN = "<|unk|>"
FIXED_WHITESPACE = [2, 4, 8, 16]
ROLES = {
    "bos_token": "<|bos|>",
    "eos_token": "<|eos|>",
    "sep_token": "<|sep|>",
    "pad_token": "<|pad|>",
    "cls_token": "<|cls|>",
    "mask_token": "<|mask|>",
}
# ----------------------------------------------------------------------------------------

WHITESPACE_MODES = ("linear", "exp", "fixed")


def _tokens(spark: SparkSession, tokens: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(t,) for t in tokens], "token string")


def special_tokens(spark: SparkSession, extra: Sequence[str] = ()) -> DataFrame:
    """Reserved control tokens, each once."""
    return _tokens(spark, [*SPECIAL_TOKENS, *extra]).distinct().orderBy("token")


def buffer_tokens(spark: SparkSession, n: int = 64, padded: bool = True) -> DataFrame:
    """``<|unused00|>``, ``<|unused01|>``, ...: room for tokens added later."""
    number = "%02d" if padded else "%d"
    return spark.range(n).select(F.format_string(f"<|unused{number}|>", "id").alias("token"))


def whitespace_tokens(
    spark: SparkSession, n: int, mode: str = "linear", single: bool = False
) -> DataFrame:
    """Runs of spaces as tokens, with their ``length``.

    ``linear`` gives n..2, ``exp`` gives 2^n..2, ``fixed`` gives 2, 4, 8, 16.
    """
    if mode == "linear":
        lengths = list(range(n, 1, -1))
    elif mode == "exp":
        lengths = [2**i for i in range(n, 0, -1)]
    elif mode == "fixed":
        lengths = FIXED_WHITESPACE
    else:
        raise ValueError(f"mode must be one of {WHITESPACE_MODES}")
    lengths = [*lengths, 1] if single else list(lengths)
    rows = spark.createDataFrame([(k,) for k in lengths], "length int")
    return rows.select(F.repeat(F.lit(" "), F.col("length")).alias("token"), "length")


def fallback_tokens(spark: SparkSession) -> DataFrame:
    """``<0x00>`` .. ``<0xFF>`` with score 0."""
    return spark.range(256).select(
        F.format_string("<0x%02X>", "id").alias("token"),
        F.col("id").cast("int").alias("byte"),
        F.lit(0.0).alias("logprob"),
    )


def added_tokens(
    spark: SparkSession,
    n_buffer: int = 64,
    byte_fallback: bool = False,
    component_mode: bool = False,
) -> DataFrame:
    """``(token, special, role)`` of every token fixed before training.

    Component mode has no special and buffer tokens. Fallback tokens are not special: they
    stand for text.
    """
    none = _tokens(spark, [])
    special = none if component_mode else special_tokens(spark)
    buffer = none if component_mode else buffer_tokens(spark, n_buffer)
    fallback = fallback_tokens(spark).select("token") if byte_fallback else none

    def tag(tokens: DataFrame, is_special: bool, role: str) -> DataFrame:
        return tokens.select("token", F.lit(is_special).alias("special"), F.lit(role).alias("role"))

    return (
        tag(special, True, "special")
        .unionByName(tag(buffer, True, "buffer"))
        .unionByName(tag(fallback, False, "fallback"))
    )


def vocab_budget(
    vocab_size: int,
    whitespace: DataFrame,
    added: DataFrame,
    alphabet: DataFrame,
    by: Sequence[str] = (),
) -> DataFrame:
    """How many tokens are left to learn.

    ``trainer_size`` is the size asked of training: the vocabulary without the whitespace
    tokens, which are appended later, and without the 256 fallback tokens. ``n_learned``
    also takes off the tokens fixed before training and the alphabet (per group ``by``).
    """
    n_white = whitespace.agg(F.count(F.lit(1))).scalar()
    n_fallback = added.agg(F.count_if(F.col("role") == "fallback")).scalar()
    n_added = added.agg(F.count_if(F.col("role") != "fallback")).scalar()
    counted = alphabet.groupBy(*by).agg(F.count(F.lit(1)).alias("n_alphabet"))
    sized = counted.withColumn("trainer_size", F.lit(vocab_size) - n_white - n_fallback)
    return sized.withColumn("n_added", n_added).withColumn(
        "n_learned", F.col("trainer_size") - F.col("n_added") - F.col("n_alphabet")
    )


def assign_roles(added: DataFrame, roles: dict[str, str] = ROLES) -> DataFrame:
    """Added tokens with the named role each one plays, if any."""
    spark = added.sparkSession
    named = spark.createDataFrame([(t, r) for r, t in roles.items()], "token string, named_role string")
    return added.join(F.broadcast(named), "token", "left")


def token_usage(corpus: DataFrame, inventory: DataFrame, key: str = "text") -> DataFrame:
    """How often each inventory token stands in the corpus: leftmost, then longest.

    The corpus is scanned once and only counts are shuffled. Tokens that never occur keep a row with 0.
    """
    found = corpus.select(F.explode(find_tokens(F.col(key), inventory)).alias("token"))
    counts = found.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return inventory.join(counts, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def find_tokens(text: Column, inventory: DataFrame) -> Column:
    """Array of the inventory tokens that stand in the text."""
    return F.filter(segments(text, inventory), lambda s: s["added"])["text"]


def char_usage(corpus: DataFrame, by: Sequence[str] = (), key: str = "text") -> DataFrame:
    """``(by..., ch, n)``: characters of the corpus, counted before they are shuffled."""
    each = corpus.select(*by, F.explode(F.split(F.col(key), "")).alias("ch")).where("ch <> ''")
    return each.groupBy(*by, "ch").agg(F.count(F.lit(1)).alias("n"))


def byte_usage(corpus: DataFrame, key: str = "text") -> DataFrame:
    """``(byte, n)``: UTF-8 bytes of the corpus, from the counts of its distinct characters."""
    pairs = F.regexp_extract_all(F.hex(F.encode("ch", "UTF-8")), F.lit("(..)"), F.lit(0))
    each = char_usage(corpus, key=key).select(F.explode(pairs).alias("hex"), "n")
    return each.groupBy(F.conv("hex", 16, 10).cast("int").alias("byte")).agg(F.sum("n").alias("n"))
