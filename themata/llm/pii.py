"""Personal data by weak supervision, with DataFrame functions only.

Patterns find candidate spans: the four base kinds (email, ip, card, phone) and further ones. Labelers vote on each
candidate with 1 (personal), -1 (not) or 0: the form's own checks, gazetteers of endings, issuers and prefixes,
cue words before it, words that speak against it, and letters or digits that touch it. Expectation-maximisation
over the counts of vote patterns in all documents estimates how reliable each labeler is, and thereby the
probability of each pattern. A logistic classifier over kind and votes is trained on these probabilities and
decides on further spans that overlap no base span. Base spans that pass their checks always stay.

There are at most ``kinds * 3 ** labelers`` patterns whatever the number of documents; only their counts reach
the driver. Finding spans is a narrow projection of the documents: no shuffle, no Python on the executors.

Positions count code points from 0, the end is exclusive. Defined cases: null and empty texts have no spans; an
empty table gives an empty table and a classifier that adds nothing; repeated rows and other columns, whatever
their names, stay as they are.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from themata.cluster import let

_NO_SPANS = "cast(array() as array<struct<start: int, stop: int, value: string>>)"

#: Stands for a single separator between digits, so that a run of both is one character class.
_JOINT = "\ue000"

# The base patterns. The look-behinds change no match: they keep the engine from trying every start in a run.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IP = r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
CARD = f"[0-9][0-9{_JOINT}]*"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Further patterns.
LOCAL_PHONE = r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
#: Length of an IBAN without spaces, by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|NL", 20: "AT|LU", 21: "CH", 22: "DE|GB|IE", 24: "AD|CZ|ES|SE", 25: "PT", 27: "FR|GR|IT", 28: "HU|PL",
}
_WHOLE_IBAN = "|".join(
    rf"(?:{names})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, names in IBAN_LENGTHS.items()
)
IBAN = rf"(?<![A-Za-z0-9])(?:{_WHOLE_IBAN}|[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{3,7}})(?![A-Za-z0-9])"

# Runs have no longest length; possessive ones are never tried at a second length.
AT_EMAIL = r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[a-z0-9-]++(?:\x20?(?:\.|[\[(]dot[\])])\x20?[a-z0-9-]{2,}+)++"
SECRET = r"(?i)(?<![a-z0-9])(?:password|passwd|token|api[_-]?key|secret)\x20?[=:]\x20?\"?[a-z0-9_+/-]{8,}+\"?"

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "short_card", "local_phone", "ssn", "iban", "at_email", "secret"]
LABELERS = ["form", "gazetteer", "cue", "against", "touching"]

# Gazetteers and word lists (fixed values).
ENDINGS = "com|org|net|edu|gov|int|info|io|de|fr|es|uk|it|nl|eu|ch|at|br|mx|ru|cn|jp|in"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
RESERVED = r"^(?:0|127|255|22[4-9]|23[0-9]|24[0-9]|25[0-4])\."
DIALLING = r"^\+(?:1|7|20|27|3[0-4]|36|39|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
COUNTRIES = "^(?:AD|AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|GR|HU|IE|IT|LU|NL|NO|PL|PT|SE)"
CUES = r"(?i)\b(?:e-?mail|mail|contact|write|tel|phone|call|fax|mobile|ip|host|server|address|card|visa|pay|iban|account|ssn|login|user|password|key)\b"
AGAINST = r"(?i)\b(?:version|release|isbn|issn|doi|order|invoice|page|sha1|sha256|commit|build|section|figure|no)\b\W*$"


def found(text: Column, pattern: str, worth: Column) -> Column:
    """Leftmost non-overlapping matches as (start, stop, value), where ``worth`` says the text may have any.

    Matches and the pieces between them come from the same scan order; running lengths give the places.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def places(h: Column) -> Column:
        with_gap = F.zip_with(h, F.slice(gaps, F.lit(1), F.size(h)), lambda value, gap: F.struct(F.length(gap).alias("gap"), value.alias("value")))
        begin = F.struct(F.lit(0).alias("at"), F.expr(_NO_SPANS).alias("spans"))

        def add(acc: Column, x: Column) -> Column:
            start = acc.at + x.gap
            stop = start + F.length(x.value)
            span = F.struct(start.alias("start"), stop.alias("stop"), x.value.alias("value"))
            return F.struct(stop.alias("at"), F.array_append(acc.spans, span).alias("spans"))

        return F.aggregate(with_gap, begin, add, lambda acc: acc.spans)

    any_hits = let(hits, lambda h: F.when(F.size(h) > 0, places(h)).otherwise(F.expr(_NO_SPANS)))
    return F.when(worth, any_hits).otherwise(F.expr(_NO_SPANS))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        doubled = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + let(doubled, lambda x: F.when(x > 9, x - 9).otherwise(x))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _checks() -> dict[str, Callable[[Column], Column]]:
    """Per kind, whether a match has the right form. For base kinds this is the stated condition."""
    digits_between = lambda v, low, high: F.length(_digits(v)).between(low, high)
    checked = lambda v, low, high: F.when(digits_between(v, low, high), luhn(_digits(v))).otherwise(False)
    return {
        "email": lambda v: F.lit(True),
        "ip": lambda v: F.forall(F.split(v, r"\."), lambda p: p.cast("double") <= 255),
        "card": lambda v: checked(v, 16, 19),
        "phone": lambda v: digits_between(v, 8, 15),
        "short_card": lambda v: checked(v, 13, 15),
        "local_phone": lambda v: ~v.rlike(r"^\(?[01]"),
        "ssn": lambda v: ~v.rlike("^(?:000|666|9)|-00-|-0000$"),
        "iban": lambda v: v.rlike(f"^(?:{_WHOLE_IBAN})$"),
        "at_email": lambda v: v.rlike(f"(?i)(?:{ENDINGS})$"),
        "secret": lambda v: v.rlike("[0-9]"),
    }


def _gazetteers() -> dict[str, Column]:
    """Per kind, the vote of its word list or prefix list on ``value``."""
    known = lambda pattern, other=0: lambda v: F.when(v.rlike(pattern), 1).otherwise(other)
    nothing = lambda v: F.lit(0)
    return {
        "email": known(rf"(?i)\.(?:{ENDINGS})$"), "ip": lambda v: F.when(v.rlike(RESERVED), -1).otherwise(0), "card": known(ISSUERS, -1),
        "phone": known(DIALLING, -1), "short_card": known(ISSUERS, -1), "local_phone": nothing, "ssn": nothing,
        "iban": known(COUNTRIES, -1), "at_email": known(rf"(?i)(?:{ENDINGS})$"), "secret": known(r"(?i)^pass|[0-9a-f]{16}"),
    }


def _matches(text: Column) -> dict[str, Column]:
    """Candidate spans of every kind."""
    numbers = text.rlike("[0-9]")
    # single separators between digits become one private character; one that is there already counts as a letter
    joined = F.regexp_replace(F.translate(text, _JOINT, "x"), r"(?<=[0-9])[\x20-](?=[0-9])", _JOINT)
    runs = lambda low, high: F.filter(
        found(joined, CARD, numbers), lambda s: F.length(F.replace(s.value, F.lit(_JOINT), F.lit(""))).between(low, high)
    )
    return {
        "email": found(text, EMAIL, text.contains("@")),
        "ip": found(text, IP, text.rlike(r"[0-9]\.[0-9]")),
        "card": runs(16, 19),
        "phone": found(text, PHONE, text.contains("+")),
        "short_card": runs(13, 15),
        "local_phone": found(text, LOCAL_PHONE, numbers & text.rlike(r"[0-9]{3}[\x20.-][0-9]{4}")),
        "ssn": found(text, SSN, numbers & text.rlike("-[0-9]{2}-")),
        "iban": found(text, IBAN, numbers & text.rlike("[A-Z]{2}[0-9]{2}")),
        "at_email": found(text, AT_EMAIL, text.rlike(r"(?i)[\[(]at[\])]")),
        "secret": found(text, SECRET, text.rlike(r"(?i)(?:password|passwd|token|key|secret)\x20?[=:]")),
    }


def candidates(text: Column) -> Column:
    """All candidates as (kind, start, stop, form, gazetteer, cue, against, touching); ``kind`` is its place in KINDS."""
    checks, lists = _checks(), _gazetteers()

    def voted(kind: str, spans: Column) -> Column:
        def vote(s: Column) -> Column:
            value = F.regexp_replace(s.value, _JOINT, "")
            before = F.substring(text, F.greatest(s.start - 23, F.lit(1)), F.least(s.start, F.lit(24)))
            after = F.substring(text, s.stop + 1, F.lit(1))
            return F.struct(
                F.lit(KINDS.index(kind)).alias("kind"), s.start.alias("start"), s.stop.alias("stop"),
                F.when(checks[kind](value), 1).otherwise(-1).alias("form"), lists[kind](value).cast("int").alias("gazetteer"),
                F.when(before.rlike(CUES), 1).otherwise(0).alias("cue"), F.when(before.rlike(AGAINST), -1).otherwise(0).alias("against"),
                F.when(before.rlike("[A-Za-z0-9]$") | after.rlike("^[A-Za-z0-9]"), -1).otherwise(0).alias("touching"),
            )

        return F.transform(spans, vote)

    return F.concat(*[voted(kind, spans) for kind, spans in _matches(text).items()])


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))


@dataclass
class SpanModel:
    """Reliabilities by labeler, and the weights of the final classifier."""

    reliability: dict[str, tuple[float, float]]  # share of right votes on personal and on other candidates
    intercept: float
    weights: list[float]  # of the kinds, then of the labelers

    def accepts(self, s: Column) -> Column:
        kinds = F.element_at(F.array(*[F.lit(w) for w in self.weights[: len(KINDS)]]), s.kind + 1)
        votes = [F.lit(w) * s[name] for name, w in zip(LABELERS, self.weights[len(KINDS) :])]
        return F.lit(self.intercept) + kinds + sum(votes) >= 0


def vote_patterns(docs: DataFrame, text_col: str = "text") -> list[tuple]:
    """``(kind, votes, count)`` of the candidates in all documents."""
    spans = docs.select(F.explode(candidates(_text(text_col))).alias("s"))
    counted = spans.groupBy("s.kind", *[f"s.{name}" for name in LABELERS]).count()
    return [(r["kind"], tuple(r[name] for name in LABELERS), r["count"]) for r in counted.collect()]


def reliabilities(patterns: list[tuple], rounds: int = 50) -> tuple[dict[str, tuple[float, float]], list[float]]:
    """Expectation-maximisation over pattern counts: shares of votes 1, -1 and 0 of each labeler on personal and on
    other candidates, from a start that trusts the votes; returns what is right, and each pattern's probability."""
    start = [1 / (1 + math.exp(-sum(votes) - 0.5)) for _, votes, _ in patterns]
    probability, shares = start, {}
    for _ in range(rounds):
        total = [sum(n * p for (_, _, n), p in zip(patterns, probability)), sum(n * (1 - p) for (_, _, n), p in zip(patterns, probability))]
        for j, name in enumerate(LABELERS):
            for side in (0, 1):
                for vote in (1, 0, -1):
                    count = sum(n * (p if side == 0 else 1 - p) for (_, votes, n), p in zip(patterns, probability) if votes[j] == vote)
                    shares[name, side, vote] = (count + 1.0) / (total[side] + 3.0)
        prior = (total[0] + 1.0) / (sum(total) + 2.0)
        odds = [
            math.log(prior / (1 - prior)) + sum(math.log(shares[name, 0, v] / shares[name, 1, v]) for name, v in zip(LABELERS, votes))
            for _, votes, _ in patterns
        ]
        probability = [1 / (1 + math.exp(-max(-30.0, min(30.0, x)))) for x in odds]
    right = {name: (shares.get((name, 0, 1), 0.0), shares.get((name, 1, -1), 0.0)) for name in LABELERS}
    return right, probability


def fit(docs: DataFrame, text_col: str = "text") -> SpanModel:
    """Reliabilities and classifier from the candidates of all documents."""
    patterns = vote_patterns(docs, text_col)
    if not patterns:
        return SpanModel({}, -1.0, [0.0] * (len(KINDS) + len(LABELERS)))
    right, probability = reliabilities(patterns)
    rows = []
    for (kind, votes, n), p in zip(patterns, probability):
        features = [float(i == kind) for i in range(len(KINDS))] + [float(v) for v in votes]
        rows += [(features, 1.0, n * p + 0.01), (features, 0.0, n * (1 - p) + 0.01)]
    table = docs.sparkSession.createDataFrame(rows, "f array<double>, label double, weight double")
    table = table.select(array_to_vector("f").alias("features"), "label", "weight").coalesce(1)
    model = LogisticRegression(weightCol="weight", regParam=1e-4, standardization=False, maxIter=100).fit(table)
    return SpanModel(right, float(model.intercept), [float(w) for w in model.coefficients])


def annotate(docs: DataFrame, model: SpanModel, text_col: str = "text", base: str = "base", spans: str = "spans") -> DataFrame:
    """``docs`` with the base spans and all spans, as arrays of (kind, start, stop) by kind and start."""
    plain = lambda array: F.array_sort(F.transform(array, lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.stop.alias("stop"))))
    every = candidates(_text(text_col))
    apart = lambda s, b: ~F.exists(b, lambda o: (o.start < s.stop) & (s.start < o.stop))
    further = lambda e, b: F.filter(
        e, lambda s: (s.kind >= len(BASE)) & (s.form == 1) & model.accepts(s) & apart(s, b)
    )
    both = let(every, lambda e: let(
        F.filter(e, lambda s: (s.kind < len(BASE)) & (s.form == 1)),
        lambda b: F.struct(plain(b).alias("b"), plain(F.concat(b, further(e, b))).alias("s")),
    ))
    taken = "__found"
    while taken in docs.columns:
        taken += "_"
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (base, spans)]
    found_ = docs.withColumn(taken, both)
    return found_.select(*kept, F.col(f"{taken}.b").alias(base), F.col(f"{taken}.s").alias(spans))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s.kind + 1), s.start, s.stop)), ",")


def redact(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; spans inside earlier ones are covered by those."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s.start.alias("start"), (-s.stop).alias("less"), s.kind.alias("kind"))))
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def add(acc: Column, s: Column) -> Column:
        fresh = s.start >= acc.at
        mark = F.when(fresh, F.concat(F.substring(text, acc.at + 1, s.start - acc.at), F.element_at(names, s.kind + 1))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc.at, -s.less).alias("at"), F.concat(acc.done, mark).alias("done"))

    return F.aggregate(by_place, begin, add, lambda acc: F.concat(acc.done, F.substring(text, acc.at + 1, F.length(text))))
