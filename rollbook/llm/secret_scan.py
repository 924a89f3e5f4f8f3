"""Secrets by two character models.

Two first-order Markov models over characters, one of random strings and one
of ordinary identifiers, are trained from labelled samples; a token is a secret
when the log-likelihood ratio of the two says so.  The samples of random
strings are the values that the fixed patterns find in the whole corpus and
strings made of digests; those of ordinary identifiers are all other long
tokens of the corpus that are made of letters only or digits only, and a list
of usual names.
Only counts of character pairs reach the driver, as many as the alphabet
squared.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.functions.staging import stage
from rollbook.llm.common import literal, placed, spans_of

BASE = ("assign", "access", "hex")
#: The kind that the models add.
ADDED = "random"
KINDS = (*BASE, ADDED)

PATTERNS = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)",
    "access": r"AKIA[A-Z0-9]{16,}+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
    ADDED: r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+",
}
_LEAST = {"assign": 6}

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_SIZE = len(ALPHABET)

# Fixed sample of ordinary identifiers.
ORDINARY = (
    "getElementsByClassName setTimeoutInterval HttpServletRequest java_util_concurrent read_parquet_file "
    "max-age-seconds content-security-policy application/octet-stream text/html/charset en_US_POSIX_locale "
    "IllegalArgumentException NullPointerException ArrayIndexOutOfBounds index_of_coincidence user_account_settings "
    "node_modules/package-lock src/main/resources docs/reference/manual images/background-large release-candidate-2024 "
    "version_1_2_3_final chapter-12-section-4 2023-11-05T12-30-00 1000000000000000 0000000000000000 "
    "----------------------------- ============================ ____________________________ "
    "COPYRIGHT_NOTICE_AND_TERMS MAX_BUFFER_SIZE_BYTES DEFAULT_CONNECTION_POOL international/organization "
    "self-contained-paragraph well-known-establishment and/or/either/neither customer_order_line_item"
).split()
_ORDINARY_WEIGHT = 20


def _valued(kind: str, spans: Column) -> Column:
    """Spans with kind and value, the value being what an assignment assigns; too short ones are dropped."""

    def one(s: Column) -> Column:
        value = F.regexp_extract(s["surface"], PATTERNS[kind], 1) if kind == "assign" else s["surface"]
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), value.alias("value"))

    return F.filter(F.transform(spans, one), lambda s: F.length(s["value"]) >= _LEAST.get(kind, 1))


def find_base(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with ``_base`` (kind, start, end, value) and ``_tokens`` (start, end, surface) outside of it."""
    text = F.col("_text")
    out = docs.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    possible = {
        "assign": F.contains(text, F.lit("=")) | F.contains(text, F.lit(":")),
        "access": F.contains(text, F.lit("AKIA")),
        "hex": None,
        ADDED: None,
    }
    for kind in KINDS:
        found, gaps = spans_of("_text", PATTERNS[kind], possible[kind])
        out = out.withColumn("_m", found).withColumn("_g", F.when(F.size("_m") > 0, gaps))
        spans = placed(F.col("_m"), F.col("_g"))
        if kind == ADDED:
            outside = lambda s: ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
            out = out.withColumn("_tokens", spans).drop("_m", "_g")
            out = out.withColumn("_tokens", F.filter("_tokens", outside))
            continue
        named = _valued(kind, spans)
        held = F.concat("_base", named) if "_base" in out.columns else named
        out = out.withColumn("_base", held).drop("_m", "_g")
    return out.drop("_text")


def _pairs(strings: Column) -> Column:
    """All neighbouring characters of the strings in an array."""
    return F.flatten(
        F.transform(
            F.filter(strings, lambda s: F.length(s) > 1),
            lambda s: F.transform(F.sequence(F.lit(1), F.length(s) - 1), lambda i: F.substr(s, i, F.lit(2))),
        )
    )


def _counted(strings: DataFrame, column: str) -> dict[str, int]:
    rows = strings.select(F.explode(_pairs(F.col(column))).alias("pair")).filter(F.col("pair").rlike("^[A-Za-z0-9+/_=-]{2}$"))
    return {r["pair"]: r["n"] for r in rows.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).collect()}


def made_secrets(spark: SparkSession, n: int = 2000) -> DataFrame:
    """Labelled random strings: the same digests in hexadecimal, base 64 and capital letters with digits."""
    digest = F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 256)
    upper = F.regexp_replace(F.upper(F.base64(F.unhex(F.sha2(digest, 256)))), "[^A-Z0-9]", "")
    return spark.range(n).select(F.array(F.base64(F.unhex(digest)), F.substring(digest, 1, 40), upper).alias("strings"))


def ratio_table(random: dict[str, int], ordinary: dict[str, int], smooth: float = 0.5) -> list[float]:
    """Log-likelihood ratio of each character pair, row by row of the alphabet.

    The model of random strings is mixed with the uniform one, so that it does
    not depend on which of them the corpus happens to hold.
    """
    out = []
    for a in ALPHABET:
        r = [random.get(a + b, 0) for b in ALPHABET]
        o = [ordinary.get(a + b, 0) for b in ALPHABET]
        rs, os_ = sum(r) + smooth * _SIZE, sum(o) + smooth * _SIZE
        for x, y in zip(r, o, strict=True):
            p = 0.7 * (x + smooth) / rs + 0.3 / _SIZE
            out.append(round(math.log(p / ((y + smooth) / os_)), 4))
    return out


def train(found: DataFrame) -> list[float]:
    """The table from a corpus; without one, from the made samples and the fixed list alone."""
    letters = F.transform(F.filter("_tokens", lambda s: s["surface"].rlike("^(?:[A-Za-z]+|[0-9]+)$")), lambda s: s["surface"])
    samples = found.select(F.transform("_base", lambda s: s["value"]).alias("random"), letters.alias("ordinary"))
    random, ordinary = _counted(samples, "random"), _counted(samples, "ordinary")
    made = _counted(made_secrets(found.sparkSession), "strings")
    # what the corpus holds counts at most as much as the made strings, else one frequent form would decide
    scale = min(1.0, sum(made.values()) / max(1, sum(random.values())))
    random = {k: made.get(k, 0) + scale * random.get(k, 0) for k in made.keys() | random.keys()}
    share = max(1, sum(ordinary.values()) // 50_000)
    for word in ORDINARY:
        for pair in zip(word, word[1:], strict=False):
            ordinary["".join(pair)] = ordinary.get("".join(pair), 0) + _ORDINARY_WEIGHT * share
    return ratio_table(random, ordinary)


def likelihood_ratio(surface: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio over the neighbouring characters of a string."""
    table, letters = literal(ratios, "array<double>"), F.lit(ALPHABET)
    at = lambda i: F.instr(letters, F.substr(surface, i, F.lit(1)))
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(surface) - 1),
        F.lit(0.0),
        lambda acc, i: acc + F.element_at(table, ((at(i) - 1) * _SIZE + at(i + 1)).cast("int")),
    )
    return total / (F.length(surface) - 1)


def spans(found: DataFrame, ratios: list[float], least: float = 0.5) -> Column:
    """Array of (kind, start, end): base spans, and tokens whose mean ratio is at least ``least``."""
    plain = lambda s, kind: F.struct(kind.alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    return F.concat(
        F.transform("_base", lambda s: plain(s, s["kind"])),
        F.transform(
            F.filter("_tokens", lambda s: likelihood_ratio(s["surface"], ratios) >= least), lambda s: plain(s, F.lit(ADDED))
        ),
    )


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """One row per document: id and ``spans``, an array of (kind, start, end) in code points, end exclusive.

    NULL and empty texts have no spans; a NULL id or a repeated row gives its
    row like any other; an empty table gives no rows.  Only the two named
    columns are read.
    """
    found = stage(find_base(docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("text")), "text").drop("text"))
    return found.select(id_col, spans(found, train(found), least).alias("spans"))
