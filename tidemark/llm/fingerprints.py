"""Fingerprints of weighted term sets by consistent weighted sampling.

A text is a set of words, each weighted by how often it occurs.  For every sample number a term
draws, from a hash of itself and that number, two variates r and c of a Gamma(2, 1) distribution
and a uniform b.  With t = floor(ln(weight) / r + b), the term of the smallest
c * exp(-r * (t - b + 1)) is the sample, together with its t.  Two texts draw the same sample
with a probability equal to their generalised Jaccard similarity, the sum of the smaller over
the sum of the larger weights; the share of equal samples estimates it, with a standard error of
sqrt(J * (1 - J) / samples).

Everything is an SQL function: texts are split into words, these counted, and the least draw of
each sample is a minimum of 64-bit numbers whose upper bits hold the draw and whose lower 16 bits
a digest of term and t.  Two different samples agree by chance in about one of 65,536 cases.

A text and its edited text share most words.  The words of the part they share are split and
counted once, and a term of equal weight in both draws once for both.

Equal texts have equal fingerprints, and letter case does not count.  Words are runs of letters
and digits; a text without one (such as the empty text) is itself its only term, so two of them
are alike only if equal.  A null text is the empty text.  Rows equal in key and text are one
document, returned as often as it occurs; they are told apart by 64-bit hashes.  The next
document is that of the next key, null keys first, ties in the order of a hash, and after the
last comes the first; a single document is its own next.  Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import numbered
from tidemark.sources.scratch import materialise

SAMPLES = 32
DIGEST_BITS = 16
SCALE = float(1 << 42)  # steps of a draw, which stays below 32, that are told apart
BETWEEN = r"[^\p{L}\p{N}]+"

OWN, OTHER, BOTH = 0, 1, 2  # whose words or terms a row holds


def _bits(number: Column, lowest: int, width: int) -> Column:
    cut = F.shiftrightunsigned(number, lowest) if lowest else number
    return cut if lowest + width == 64 else cut.bitwiseAND(F.lit((1 << width) - 1))


def _uniform(number: Column, lowest: int, width: int) -> Column:
    return (_bits(number, lowest, width) + 0.5) * (1.0 / (1 << width))


def draw(term: Column, log_weight: Column, sample: int) -> Column:
    """A term's draw in the upper bits, the digest of term and step in the lower."""
    drawn = F.xxhash64(term, F.lit(sample))
    r = -F.log(_uniform(drawn, 0, 11) * _uniform(drawn, 11, 11))
    b = _uniform(drawn, 22, 10)
    c = -F.log(_uniform(drawn, 32, 16) * _uniform(drawn, 48, 16))
    step = F.floor(log_weight / r + b)
    value = c * F.exp(-r * (step - b + 1))
    return F.shiftleft((value * SCALE).cast("long"), DIGEST_BITS).bitwiseOR(
        _bits(drawn.bitwiseXOR(step), 0, DIGEST_BITS))


def least_draws(weighted: DataFrame, by: list[str], samples: int = SAMPLES) -> DataFrame:
    """``by`` and the least draw ``s0``, ``s1`` ... of each sample, from rows of ``term`` (a hash)
    and ``weight``.  Draws of parts of a text are merged by taking the least again."""
    logged = weighted.withColumn("log_weight", F.log(F.col("weight").cast("double")))
    return logged.groupBy(*by).agg(*[
        F.min(draw(F.col("term"), F.col("log_weight"), i)).alias(f"s{i}") for i in range(samples)])


def fingerprint(draws: list[Column]) -> Column:
    """Two bytes a sample."""
    digests = [_bits(d, 0, DIGEST_BITS) for d in draws]
    return F.unhex(F.concat(*[F.lpad(F.hex(d), 4, "0") for d in digests]))


def words_of(text: Column) -> Column:
    """The words of a text, between an empty one where it starts or ends with none."""
    return F.split(text, BETWEEN)


def shared_words(texts: DataFrame) -> DataFrame:
    """Rows of ``name``, ``of`` and ``term``: every word of ``kept`` + ``own`` and of ``kept`` +
    ``other``, once for both where it lies in ``kept`` alone."""
    parts = texts.select("name", words_of(F.col("kept")).alias("words"), "kept", "own", "other")
    # The last word of the shared part may go on in what follows it.
    whole, torn = F.slice("words", 1, F.size("words") - 1), F.element_at("words", -1)
    parts = parts.select("name", "kept", "own", "other", whole.alias("whole"), *[
        F.array_remove(words_of(F.concat(torn, F.col(c))), "").alias(f"{c}_words")
        for c in ("own", "other")])
    none = F.size(F.array_remove("whole", "")) == 0
    sides = [F.struct(F.lit(BOTH).alias("of"), F.col("whole").alias("words"))]
    for of, c in ((OWN, "own"), (OTHER, "other")):
        text_itself = F.array(F.concat("kept", c))
        sides.append(F.struct(F.lit(of).alias("of"), F.when(
            none & (F.size(f"{c}_words") == 0), text_itself).otherwise(F.col(f"{c}_words"))
            .alias("words")))
    rows = parts.select("name", none.alias("none"), F.explode(F.array(*sides)).alias("side"))
    words = rows.select("name", "none", "side.of", F.explode("side.words").alias("word"))
    # Empty pieces are no words, but an empty text without words is its own term.
    return words.where((F.col("word") != "") | F.col("none") & (F.col("of") != BOTH)).select(
        "name", "of", F.xxhash64(F.lower("word")).alias("term"))


def fingerprints(texts: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``name``, and the fingerprints ``first`` of ``kept`` + ``own`` and ``second`` of ``kept`` +
    ``other``."""
    of = F.col("of")
    counted = shared_words(texts).groupBy("name", "term").agg(
        F.sum((of != OTHER).cast("int")).alias("own"), F.sum((of != OWN).cast("int")).alias("other"))
    alike = F.array(F.struct(F.lit(BOTH).alias("of"), F.col("own").alias("weight")))
    apart = F.array(F.struct(F.lit(OWN).alias("of"), F.col("own").alias("weight")),
                    F.struct(F.lit(OTHER).alias("of"), F.col("other").alias("weight")))
    weighted = counted.select("name", "term", F.explode(
        F.when(F.col("own") == F.col("other"), alike).otherwise(apart)).alias("w")).select(
        "name", "term", "w.of", "w.weight").where("weight > 0")
    draws = least_draws(weighted, ["name", "of"], samples)

    def merged(side: int) -> Column:
        return fingerprint([F.min(F.when(of.isin(side, BOTH), F.col(f"s{i}")))
                            for i in range(samples)])

    return draws.groupBy("name").agg(merged(OWN).alias("first"), merged(OTHER).alias("second"))


def readable(fingerprint: Column) -> Column:
    return F.lower(F.hex(fingerprint))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints."""
    left, right = F.hex(a), F.hex(b)
    same = [(F.substring(left, 4 * i + 1, 4) == F.substring(right, 4 * i + 1, 4)).cast("int")
            for i in range(samples)]
    return sum(same[1:], same[0]) / F.lit(float(samples))


def with_next(rows: DataFrame) -> DataFrame:
    """``name``, ``key``, ``copies``, ``n_chars`` and the name of the ``next`` document."""
    ordered = materialise(
        numbered(rows, [F.asc_nulls_first("key"), F.asc("name")], "place", "fingerprint-order"),
        "fingerprint-places")
    many = max(1, ordered.count())
    follower = ordered.select(F.pmod(F.col("place") - 1, F.lit(many)).alias("place"),
                              F.col("name").alias("next"))
    return ordered.join(follower, "place").drop("place")


def edited(texts: DataFrame, order: DataFrame) -> DataFrame:
    """``name`` and a text in two parts, ``kept`` and ``own``, the last quarter, in whose place the
    edited text has ``other``: as many code points from the start of the next document.  Only
    those are sent to it."""
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    wanted = order.select(F.col("next").alias("name"), F.col("name").alias("to"), cut.alias("cut"))
    heads = texts.join(wanted, "name").select(
        F.col("to").alias("name"), F.col("text").substr(F.lit(1), F.col("cut")).alias("other"))
    left = (F.col("n_chars") - cut).cast("int")
    return texts.join(order.select("name", "n_chars"), "name").join(heads, "name").select(
        "name", F.col("text").substr(F.lit(1), left).alias("kept"),
        F.col("text").substr(left + 1, cut + 1).alias("own"), "other")


def compare_edits(df: DataFrame, key: str = "doc_id", text: str = "text",
                  samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    ``key``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited`` and ``near_next``.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    named = df.select(
        F.xxhash64(F.col(key).isNull(), F.col(key), body).alias("name"), F.col(key).alias("key"),
        body.alias("text"))
    order = materialise(with_next(materialise(
        named.select("name", "key", F.length("text").cast("long").alias("n_chars"))
        .groupBy("name", "key", "n_chars").agg(F.count(F.lit(1)).alias("copies")),
        "fingerprint-rows")), "fingerprint-next")
    # One text of each name, reduced where it lies; joins and counts keep this partitioning.
    both = edited(named.select("name", "text").dropDuplicates(["name"]), order)
    digest = F.sha2(F.concat("kept", "other").cast("binary"), 256)
    made = materialise(
        fingerprints(both, samples).join(both.select("name", digest.alias("digest")), "name"),
        "fingerprints")
    following = made.select(F.col("name").alias("next"), F.col("first").alias("follows"))
    return (order.join(made, "name").join(following, "next")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select(F.col("key").alias(key), "n_chars", F.col("digest").alias("edited_sha256"),
                    readable(F.col("first")).alias("fingerprint"),
                    readable(F.col("second")).alias("edited_fingerprint"),
                    likeness(F.col("first"), F.col("second"), samples).alias("near_edited"),
                    likeness(F.col("first"), F.col("follows"), samples).alias("near_next")))
