"""Personal data by weak supervision.

Patterns propose spans.  Regex, checksum, gazetteer and context labelers vote
on each proposal (1 for, -1 against, 0 silent).  Expectation-maximisation over
the counts of vote patterns estimates how reliable each labeler is and how
likely each pattern is personal data; these posteriors train the final
classifier, a logistic regression over kind, votes and shape, which is applied
as a column expression.  What reaches the driver are counts of vote patterns,
whose number is bounded by kinds and voters, not by the input.

Four base kinds follow fixed rules and are always kept.  The classifier decides
on the further kinds.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.staging import stage
from rollbook.llm.common import placed, spans_of

BASE = ("email", "ip", "card", "phone")
FURTHER = ("email_spelled", "card_grouped", "phone_local", "ssn", "iban", "birth", "person", "ipv6")
KINDS = BASE + FURTHER

# Base patterns. Possessive loops and look-behinds give the leftmost matches of the plain forms in linear time:
# a match can start only at the start of a run or right after the last match.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a chain of digits with at most one blank or hyphen between two of them, 12 to 19 digits in all
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "email_spelled": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\(at\)|\[at\]| at )"
    r" ?[A-Za-z0-9-]{1,63}+ ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,12}\b",
    "card_grouped": r"(?<![0-9])[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])",
    "phone_local": r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z.-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "birth": r"(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4})(?![0-9])",
    "person": r"(?:\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.? )(?:[A-Z][a-z]{1,20}+ ?){1,3}",
    "ipv6": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
}

# Fixed values of the gazetteers, in lower case.
MAIL_ENDINGS = "com org net edu gov info biz io de fr es it uk eu us ch at nl be pl se no dk fi pt ca au jp in br mx".split()
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 61 62 63 64 65 81 82 86 90 91".split()
GIVEN_NAMES = (
    "james john robert michael william david richard thomas mary patricia jennifer linda elizabeth barbara susan anna "
    "maria peter paul hans karl klaus petra ursula jean pierre marie luc claire jose carlos juan ana carmen luis laura "
    "sarah emma olivia noah liam jane alice bob carol daniel"
).split()
CUES = {
    "email": "mail|contact|write to|reach|kontakt|correo|courriel",
    "ip": "ip|host|server|address|adresse|client|login|from",
    "card": "card|visa|master ?card|amex|karte|carte|tarjeta|payment|credit|account",
    "phone": "phone|call|tel|mobile|fax|cell|telefon|appeler|llame|contact",
    "email_spelled": "mail|contact|write to|reach|kontakt|correo|courriel",
    "card_grouped": "card|visa|master ?card|amex|karte|carte|tarjeta|payment|credit|account",
    "phone_local": "phone|call|tel|mobile|fax|cell|telefon|appeler|llame|contact",
    "ssn": "ssn|social security|security number|soc sec",
    "iban": "iban|account|konto|compte|cuenta|bank",
    "birth": "born|birth|dob|geboren|naissance|nacido|nacimiento|geb",
    "person": "name|dear|contact|signed|by|von|chez|by",
    "ipv6": "ip|host|server|address|adresse|client|login|from",
}
COUNTER_CUES = "isbn|version|release|order|invoice|sku|serial|part no|build|ticket|revision|chapter|section"
_CONTEXT = 32
VOTERS = ("shape", "check", "gazetteer", "cue", "counter", "variety")
FLAGS = ("glued_left", "glued_right", "mostly_digits")


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(c: Column) -> Column:
    """Whether the digits of ``c`` pass the Luhn test."""
    number = F.reverse(_digits(c))
    total = F.aggregate(
        F.split(number, ""),
        F.struct(F.lit(0).alias("sum"), F.lit(False).alias("double")),
        lambda acc, d: F.when(d == "", acc).otherwise(
            F.struct(
                (
                    acc["sum"]
                    + F.when(acc["double"], (d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")).otherwise(d.cast("int"))
                ).alias("sum"),
                (~acc["double"]).alias("double"),
            )
        ),
    )["sum"]
    return total % 10 == 0


def _octets(c: Column) -> Column:
    """Whether each part of a dotted number is at most 255, leading zeros aside."""
    return F.forall(
        F.split(c, r"\."),
        lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
        & (F.substring(F.concat(F.lit("000"), F.ltrim(p, F.lit("0"))), -3, 3).cast("int") <= 255),
    )


def _iban_check(c: Column) -> Column:
    """Whether an account number leaves 1 modulo 97; letters count from 10."""
    plain = F.replace(c, F.lit(" "))
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    return (
        F.aggregate(
            F.filter(F.split(moved, ""), lambda x: x != ""),
            F.lit(0),
            lambda acc, x: F.when(
                x.rlike("[0-9]"), (acc * 10 + x.cast("int")) % 97
            ).otherwise((acc * 100 + F.ascii(x) - 55) % 97),
        )
        == 1
    )


def _number_range(c: Column, low: int, high: int) -> Column:
    return F.length(_digits(c)).between(low, high)


def _accepted(kind: str, spans: Column) -> Column:
    """Base spans that hold their kind's rule."""
    rule = {
        "email": None,
        "ip": lambda s: _octets(s["surface"]),
        "card": lambda s: _number_range(s["surface"], 12, 19) & _luhn(s["surface"]),
        "phone": lambda s: _number_range(s["surface"], 9, 15),
    }.get(kind)
    return F.filter(spans, rule) if rule else spans


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(F.coalesce(yes, F.lit(False)), 1)
    if no is not None:
        out = out.when(F.coalesce(no, F.lit(False)), -1)
    return out.otherwise(0)


def _votes(kind: str, surface: Column, left: Column, right: Column) -> list[Column]:
    """The labelers on one span, in the order of VOTERS."""
    digits, low = _digits(surface), F.lower(surface)
    never = F.lit(False)
    any_of = lambda values: "|".join(values)
    shape, check, known = (never, None), (never, None), (never, None)
    if kind in ("email", "email_spelled"):
        ending = rf"(?:\.|dot\]? |dot\) ?)(?:{any_of(MAIL_ENDINGS)})$"
        shape = (low.rlike(r"^[a-z0-9][a-z0-9._%+-]*[a-z0-9]? ?(?:@|\(at\)|\[at\]| at )"), low.rlike(r"\.\.|^[._%+-]"))
        known = (low.rlike(ending), ~low.rlike(r"[a-z]{2,12}$"))
    elif kind == "ip":
        shape = (surface.rlike(r"^(?:[1-9][0-9]{0,2}\.)(?:(?:0|[1-9][0-9]{0,2})\.){2}(?:0|[1-9][0-9]{0,2})$"), surface.rlike(r"(?:^|\.)0[0-9]"))
        check = (_octets(surface), ~_octets(surface))
        known = (never, surface.rlike(r"^(?:0|127|255)\."))
    elif kind in ("card", "card_grouped"):
        shape = (surface.rlike(r"^(?:[0-9]{12,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7})$"), surface.rlike("[ -].*[ -].*[ -].*[ -].*[ -]"))
        check = (_luhn(surface), ~_luhn(surface))
        known = (digits.rlike(r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"), digits.rlike("^[01789]"))
    elif kind in ("phone", "phone_local"):
        shape = (surface.rlike(r"^\+?[0-9]{0,3} ?\(?[0-9]{2,4}\)?[ .-]?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}$"), surface.rlike(r"\.\.|--|\(\("))
        known = (surface.rlike(rf"^\+(?:{any_of(CALLING_CODES)})") | digits.rlike("^[2-9][0-9]{2}[2-9]"), digits.rlike("^(?:000|[01]11)"))
    elif kind == "ssn":
        shape = (~surface.rlike(r"^(?:000|666|9)|-00-|-0000$"), surface.rlike(r"^(?:000|666|9)|-00-|-0000$"))
    elif kind == "iban":
        shape = (F.length(F.replace(surface, F.lit(" "))).between(15, 34), ~F.length(F.replace(surface, F.lit(" "))).between(15, 34))
        check = (_iban_check(surface), ~_iban_check(surface))
        known = (surface.rlike("^(?:AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)"), None)
    elif kind == "birth":
        known = (surface.rlike("(?:19|20)[0-9]{2}"), ~surface.rlike("(?:1[89]|20)[0-9]{2}"))
    elif kind == "person":
        known = (low.rlike(rf"\b(?:{any_of(GIVEN_NAMES)})\b"), None)
        shape = (surface.rlike(r"^\S+ [A-Z][a-z]+ [A-Z][a-z]+ ?$"), None)
    elif kind == "ipv6":
        shape = (low.rlike("[a-f]") & low.rlike("[0-9]"), None)
    near = F.lower(left)
    repeated = digits.rlike(r"^(\d)\1{6,}") | low.rlike(r"example\.(?:invalid|test)$")
    return [
        _vote(*shape),
        _vote(*check),
        _vote(*known),
        _vote(near.rlike(rf"(?:{CUES[kind]})[^a-z0-9]{{1,4}}(?:[a-z]{{1,10}}[^a-z0-9]{{1,3}})?$")),
        _vote(never, near.rlike(rf"(?:{COUNTER_CUES})[^a-z0-9]{{1,4}}(?:no\.? ?|number ?|# ?)?$")),
        _vote(never, repeated),
    ]


def _judged(kind: str, spans: Column, text: Column) -> Column:
    """Spans with kind, votes and flags."""

    def one(s: Column) -> Column:
        size = F.least(s["start"], F.lit(_CONTEXT))
        left = F.substr(text, s["start"] - size + 1, size)
        right = F.substr(text, s["end"] + 1, F.lit(1))
        votes = F.array(*_votes(kind, s["surface"], left, right)).cast("array<tinyint>")
        flags = F.array(
            F.coalesce(left.rlike("[A-Za-z0-9]$"), F.lit(False)),
            F.coalesce(right.rlike("^[A-Za-z0-9]"), F.lit(False)),
            F.length(_digits(s["surface"])) * 2 > F.length(s["surface"]),
        )
        return F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), votes.alias("votes"), flags.alias("flags")
        )

    return F.transform(spans, one)


def propose(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_base`` and ``_more``: arrays of (kind, start, end, votes, flags), base kinds accepted by rule.

    Each text is gone through where it lies; nothing is shuffled.
    """
    text = F.col("_text")
    out = docs.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    out = out.withColumn("_digit", F.col("_text").rlike("[0-9]"))
    possible = {
        "email": F.contains(text, F.lit("@")),
        "ip": F.col("_digit") & F.contains(text, F.lit(".")),
        "card": F.col("_digit"),
        "phone": F.col("_digit") & F.contains(text, F.lit("+")),
        "email_spelled": text.rlike(r"(?:[(\[ ]dot[)\] ])"),
        "card_grouped": F.col("_digit"),
        "phone_local": F.col("_digit"),
        "ssn": F.col("_digit") & F.contains(text, F.lit("-")),
        "iban": F.col("_digit"),
        "birth": F.col("_digit"),
        "person": F.lit(True),
        "ipv6": F.col("_digit") & F.contains(text, F.lit(":")),
    }
    for kind in KINDS:
        found, gaps = spans_of("_text", PATTERNS[kind], possible[kind])
        out = out.withColumn("_m", found).withColumn("_g", F.when(F.size("_m") > 0, gaps))
        out = out.withColumn(f"_s_{kind}", placed(F.col("_m"), F.col("_g"))).drop("_m", "_g")
        if kind in BASE:
            out = out.withColumn(f"_s_{kind}", _accepted(kind, F.col(f"_s_{kind}")))
    out = out.withColumn("_base", F.concat(*[_judged(k, F.col(f"_s_{k}"), text) for k in BASE]))
    more = F.concat(*[_judged(k, F.col(f"_s_{k}"), text) for k in FURTHER])
    outside = lambda s: ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    out = out.withColumn("_more", F.filter(more, outside))
    return out.drop("_text", "_digit", *[f"_s_{k}" for k in KINDS])


@dataclass(frozen=True)
class SpanModel:
    """Reliability of each labeler, and the weights of the final classifier."""

    reliability: dict[str, float]
    bias: float
    kind: dict[str, float]
    vote: list[tuple[float, float]]
    flag: list[float]

    def logit(self, s: Column) -> Column:
        total = F.lit(self.bias)
        for k, w in self.kind.items():
            total = total + F.when(s["kind"] == k, F.lit(w)).otherwise(0.0)
        for i, (for_, against) in enumerate(self.vote):
            v = F.element_at(s["votes"], i + 1)
            total = total + F.when(v == 1, F.lit(for_)).when(v == -1, F.lit(against)).otherwise(0.0)
        for i, w in enumerate(self.flag):
            total = total + F.when(F.element_at(s["flags"], i + 1), F.lit(w)).otherwise(0.0)
        return total


def estimate(counts: list[tuple[str, tuple[int, ...], tuple[bool, ...], int]], rounds: int = 30, steps: int = 200) -> SpanModel:
    """Fit on counts of (kind, votes, flags): EM for the labelers, then the classifier on the posteriors.

    The labelers are taken as independent given the truth.  Start values and
    pseudo-counts say that labelers are mostly right and silence says little;
    without any counts they are the model.
    """
    m = len(VOTERS)
    start = {1: {1: 0.45, 0: 0.5, -1: 0.05}, 0: {1: 0.1, 0: 0.5, -1: 0.4}}
    table = [{y: dict(start[y]) for y in (0, 1)} for _ in range(m)]
    prior = {k: 0.9 if k in BASE else 0.3 for k in KINDS}
    belief = [0.5] * len(counts)
    for _ in range(rounds):
        for i, (kind, votes, _, _) in enumerate(counts):
            odds = math.log(prior[kind] / (1 - prior[kind])) + sum(
                math.log(table[j][1][v] / table[j][0][v]) for j, v in enumerate(votes)
            )
            belief[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        for j in range(m):
            for y in (0, 1):
                sums = {v: 50 * start[y][v] for v in (1, 0, -1)}
                for b, (_, votes, _, n) in zip(belief, counts, strict=True):
                    sums[votes[j]] += n * (b if y else 1 - b)
                whole = sum(sums.values())
                table[j][y] = {v: s / whole for v, s in sums.items()}
        for k in KINDS:
            first = 0.9 if k in BASE else 0.3
            rows = [(b, n) for b, (kind, _, _, n) in zip(belief, counts, strict=True) if kind == k]
            share = (sum(b * n for b, n in rows) + 20 * first) / (sum(n for _, n in rows) + 20)
            prior[k] = min(0.99, max(0.01, share))
    reliability = {}
    for j, name in enumerate(VOTERS):
        right, wrong = table[j][1][1] + table[j][0][-1], table[j][1][-1] + table[j][0][1]
        reliability[name] = right / (right + wrong)

    # classifier: logistic regression on the posteriors, started at the labelers' own log-odds
    bias, vote = 0.0, [[math.log(t[1][1] / t[0][1]), math.log(t[1][-1] / t[0][-1])] for t in table]
    kinds, flags = {k: math.log(prior[k] / (1 - prior[k])) for k in KINDS}, [0.0] * len(FLAGS)
    weights = [math.log1p(n) for _, _, _, n in counts]
    whole = sum(weights) or 1.0
    for _ in range(steps if counts else 0):
        g_kind, g_vote, g_flag = dict.fromkeys(KINDS, 0.0), [[0.0, 0.0] for _ in range(m)], [0.0] * len(FLAGS)
        for b, w, (kind, votes, marks, _) in zip(belief, weights, counts, strict=True):
            z = bias + kinds[kind] + sum(vote[j][0 if v == 1 else 1] for j, v in enumerate(votes) if v)
            z += sum(f for f, on in zip(flags, marks, strict=True) if on)
            miss = w * (b - 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))) / whole
            g_kind[kind] += miss
            for j, v in enumerate(votes):
                if v:
                    g_vote[j][0 if v == 1 else 1] += miss
            for j, on in enumerate(marks):
                if on:
                    g_flag[j] += miss
        kinds = {k: v + 0.5 * g_kind[k] for k, v in kinds.items()}
        vote = [[a + 0.5 * ga, c + 0.5 * gc] for (a, c), (ga, gc) in zip(vote, g_vote, strict=True)]
        flags = [f + 0.5 * g - 0.0005 * f for f, g in zip(flags, g_flag, strict=True)]
    return SpanModel(reliability, bias, kinds, [tuple(v) for v in vote], flags)


def train(proposed: DataFrame) -> SpanModel:
    """Fit on all proposals of a corpus; they are counted by pattern before they leave the executors."""
    every = proposed.select(F.explode(F.concat("_base", "_more")).alias("s"))
    rows = every.groupBy(F.col("s.kind").alias("kind"), F.col("s.votes").alias("votes"), F.col("s.flags").alias("flags")).agg(
        F.count(F.lit(1)).alias("n")
    )
    counts = [(r["kind"], tuple(r["votes"]), tuple(r["flags"]), r["n"]) for r in rows.collect()]
    return estimate(sorted(counts))


def spans(proposed: DataFrame, model: SpanModel, least: float = 0.5) -> Column:
    """Array of (kind, start, end, base): all base spans, and further ones the classifier gives at least ``least``."""
    cut = math.log(least / (1 - least))
    plain = lambda s, base: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(base).alias("base")
    )
    return F.concat(
        F.transform("_base", lambda s: plain(s, True)),
        F.transform(F.filter("_more", lambda s: model.logit(s) >= cut), lambda s: plain(s, False)),
    )


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """One row per document: id and ``spans``, an array of (kind, start, end, base) in code points, end exclusive.

    NULL and empty texts have no spans; a NULL id or a repeated row gives its
    row like any other; an empty table gives no rows (the model is then the
    start values).  Only the two named columns are read.
    """
    proposed = stage(propose(docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("text")), "text").drop("text"))
    return proposed.select(id_col, spans(proposed, train(proposed), least).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` with each span in ``text_col`` replaced by its kind in brackets, as ``[EMAIL]``.

    All columns stay; a NULL text stays NULL; spans that overlap become one.
    """
    packed = docs.select(F.struct("*").alias("_row"), F.col(text_col).alias("text"))
    proposed = stage(propose(packed, "text").drop("text"))
    found = F.array_sort(
        F.transform(
            spans(proposed, train(proposed), least), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        )
    )
    text = F.col("_row")[text_col]
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    step = lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(
            s["start"] >= acc["at"],
            F.concat(
                acc["out"],
                F.array(
                    F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
                ),
            ),
        )
        .otherwise(acc["out"])
        .alias("out"),
    )
    rebuilt = F.aggregate(
        "_found", zero, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(text, acc["at"] + 1, F.length(text)))
    )
    cleaned = proposed.withColumn("_found", found).withColumn("_clean", F.when(F.size("_found") > 0, rebuilt).otherwise(text))
    return cleaned.select(F.col("_row").withField(text_col, F.col("_clean")).alias("_row")).select("_row.*")
