"""Personal data by weak supervision, in DataFrame operations only.

Base kinds (email, ip, card, phone) are patterns with exact checks.  Beyond them three kinds are
learned: secrets (keys, passwords, access tokens), names of persons, and postal addresses.  Each
has a wide pattern of candidates on which several labelers vote: patterns of known forms, a
gazetteer, and the context before and after.  The votes are counted by pattern,
expectation-maximisation over those few counts estimates how often each labeler is right, and
the resulting soft labels train a naive-Bayes span classifier over features of the candidate and
its surroundings.  Candidates on which no labeler votes teach nothing, but the classifier is
asked about them too: it needs a probability of SURE there, and a half where a labeler has voted
for the kind.  It is compiled back into a column expression, so the spans of every text are found
in one scan without a shuffle.

Patterns are written so that Java's matcher neither recurses nor backtracks over long runs:
runs are possessive, and separators are admitted by a look-around of one character.  They
find the same leftmost, non-overlapping matches as the plain forms given beside them.

Defined results: a null or empty text has no spans; spans of different kinds may overlap,
those of a kind don't; a learned kind for which no labeler votes has no spans; spans that begin
at one place are listed in the order of the kinds; very long texts are scanned whole; rows
without a doc_id are kept, repeated rows are all returned; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialised

# The base patterns and, in comments, their plain forms.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@(?=[A-Za-z0-9-]++\.[A-Za-z0-9-])(?:[A-Za-z0-9.-](?<!\.(?![A-Za-z0-9-])))*+",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[0-9\x20-](?<![\x20-](?![0-9])))*+",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A word of letters, digits and _ / + - of eight or more with a digit and a letter.
CANDIDATE = r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9])(?=[0-9_/+-]*+[A-Za-z])[A-Za-z0-9_/+-]{8,}+"
# Words that announce a secret.
GAZETTEER = "password passwd passphrase pwd secret token apikey api_key access_key private_key credential credentials auth bearer".split()
KEY_FORMS = r"^(AKIA[0-9A-Z]{12,}|gh[pousr]_[A-Za-z0-9]{16,}|sk-[A-Za-z0-9]{16,}|xox[abpr]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_-]{20,}|[0-9a-f]{16,}|[0-9A-F]{16,})$"


def spans(text: Column, pattern: str) -> Column:
    """array<struct<start, end, match>> of all matches, in code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    step = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.struct(m.alias("m"), F.length(g).alias("g"), F.length(m).alias("n")))
    empty = F.array().cast("array<struct<start:int,end:int,m:string>>")
    zero = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    add = lambda s, x: F.struct((s["at"] + x["g"] + x["n"]).alias("at"), F.concat(s["out"], F.array(F.struct((s["at"] + x["g"]).alias("start"), (s["at"] + x["g"] + x["n"]).alias("end"), x["m"].alias("m")))).alias("out"))
    return F.aggregate(step, zero, add, lambda s: s["out"])


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    doubled = F.transform(F.split(F.reverse(d), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10)))
    return F.aggregate(doubled, F.lit(0).cast("long"), lambda s, x: s + x) % 10 == 0


CHECKS = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.split(m, r"\."), lambda p: F.coalesce(p.try_cast("int"), F.lit(999)) <= 255),
    "card": lambda m: F.length(digits(m)).between(14, 19) & luhn(digits(m)),
    "phone": lambda m: F.length(digits(m)).between(10, 15),
}
# What a text must hold for a kind to be looked for at all.
NEEDS = {"email": lambda t: t.contains("@"), "phone": lambda t: t.contains("+"), "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"), "card": lambda t: t.rlike("[0-9]")}


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text and one array of checked spans for each base kind."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    none = F.array().cast("array<struct<start:int,end:int,m:string>>")
    d = d.select("doc_id", "text", *[F.when(NEEDS[k](F.col("text")), spans(F.col("text"), p)).otherwise(none).alias(k) for k, p in PATTERNS.items()])
    checked = lambda k: F.filter(k, lambda s: CHECKS[k](s["m"])).alias(k)
    return d.select("doc_id", "text", *map(checked, PATTERNS))


CANDIDATES = "array<struct<start:int,end:int,m:string,before:string,after:string>>"
BEFORE, AFTER = 24, 16  # characters of context
SURE = 0.95  # probability that a candidate without a vote needs
Rules = Mapping[str, Callable[[Column], Column]]


@dataclass(frozen=True)
class Learned:
    """A learned kind.  Labelers say 1 (of the kind), 0 (not) or null (no vote) of a candidate,
    features are its few-valued properties; `needs` is a test of the whole text."""

    pattern: str
    needs: Callable[[Column], Column]
    labelers: Rules
    features: Rules

    def candidates(self, text: Column) -> Column:
        """Spans with the characters before (in lower case) and after."""
        before = lambda s: F.lower(F.substring(text, F.greatest(s["start"] - BEFORE + 1, F.lit(1)), F.least(s["start"], F.lit(BEFORE))))
        looked = F.transform(spans(text, self.pattern), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["m"].alias("m"), before(s).alias("before"), F.substring(text, s["end"] + 1, F.lit(AFTER)).alias("after")))
        return F.when(self.needs(text), looked).otherwise(F.array().cast(CANDIDATES))


def either(c: Column, pattern: str) -> Column:
    """yes or no, as a feature."""
    return F.when(c.rlike(pattern), "yes").otherwise("no")


ANNOUNCED = "(?:" + "|".join(GAZETTEER) + r")[^A-Za-z0-9]{0,5}$"
SECRET = Learned(
    CANDIDATE,
    lambda t: t.rlike(r"[0-9]") & t.rlike(r"[A-Za-z_][0-9]|[0-9][A-Za-z_]"),
    {
        "form": lambda c: F.when(c["m"].rlike(KEY_FORMS), 1).when(c["m"].rlike(r"^[A-Za-z]{1,12}[0-9]{1,4}$|^[0-9]{1,4}[A-Za-z]{1,12}$|-"), 0),
        "gazetteer": lambda c: F.when(c["before"].rlike(ANNOUNCED), 1).when(~c["before"].rlike("|".join(GAZETTEER)), 0),
        "assigned": lambda c: F.when(c["before"].rlike(r"[a-z_]\s?[=:]\s?[\"']?$"), 1),
        "mixture": lambda c: F.when((F.length(c["m"]) >= 16) & (F.length(F.regexp_replace(c["m"], "[^0-9]", "")) >= 3), 1).when(F.length(c["m"]) < 12, 0),
    },
    {
        "length": lambda c: F.least(F.floor(F.length(c["m"]) / 4), F.lit(12)).cast("string"),
        "digits": lambda c: F.floor(F.length(F.regexp_replace(c["m"], "[^0-9]", "")) * 5 / F.length(c["m"])).cast("string"),
        "case": lambda c: F.when(c["m"].rlike("^[^a-z]*$"), "upper").when(c["m"].rlike("^[^A-Z]*$"), "lower").otherwise("mixed"),
        "hex": lambda c: c["m"].rlike("^[0-9a-fA-F]+$").cast("string"),
        "before": lambda c: F.when(c["before"].rlike(ANNOUNCED), "word").when(c["before"].rlike(r"[=:]\s?[\"']?$"), "assign").when(c["before"].rlike(r"\s$|^$"), "space").otherwise("other"),
        "after": lambda c: F.when(c["after"].rlike(r"^[\"']"), "quote").when(c["after"].rlike(r"^[.@]\S"), "joined").when(c["after"] == "", "end").otherwise("other"),
    },
)

# Common given names, words that no person's name has, and words before a name.
GIVEN = "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph Jessica Thomas Sarah Charles Karen Christopher Nancy Daniel Lisa Matthew Margaret Anthony Sandra Mark Ashley Paul Emily Steven Anna Andrew Laura Peter Julia Hans Maria Pierre Claire Jean Sophie Juan Carmen Carlos Lucia Miguel Elena Klaus Petra".split()
NO_NAME = "The This That These Those There And But For With From Our Your New North South East West United Street Road Avenue University College Institute Company Bank City County State Department Ministry Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March April May June July August September October November December".split()
PERSON_CUE = r"(?:\b(?:mr|mrs|ms|dr|prof)\.?|\bname(?: is|:)?|\bnamed|\bsigned(?: by|:)?|\bcontact:?|\bdear|\bauthor:?|\bpatient:?|\bregards,)\s*$"
_WORDED = r"\b(?:" + "|".join(NO_NAME) + r")\b"
_FIRST = r"^(?:" + "|".join(GIVEN) + r")\b"
NAME = Learned(
    # two to four capitalised words, an initial between them
    r"(?<![\p{L}\p{N}])\p{Lu}\p{Ll}++(?:\x20\p{Lu}\.)?+(?:\x20\p{Lu}\p{Ll}++(?:-\p{Lu}\p{Ll}++)?+){1,3}+(?![\p{L}\p{N}])",
    lambda t: t.rlike(r"\p{Ll}\x20\p{Lu}[\p{Ll}.]"),
    {
        "given": lambda c: F.when(c["m"].rlike(_FIRST), 1).when(c["m"].rlike(_WORDED), 0),
        "cue": lambda c: F.when(c["before"].rlike(PERSON_CUE), 1),
        "ordinary": lambda c: F.when(c["m"].rlike(_WORDED), 0),
        "opening": lambda c: F.when(c["before"].rlike(r"(?:^|[.!?\n]\s*)$") & ~c["m"].rlike(_FIRST), 0),
        "numbered": lambda c: F.when(c["before"].rlike(r"[0-9]\s$"), 0),
        "contact": lambda c: F.when(c["after"].rlike(r"^,? ?[(<]?(?:\+|[A-Za-z0-9._%+-]+@|born\b|aged\b)"), 1),
    },
    {
        "given": lambda c: either(c["m"], _FIRST),
        "ordinary": lambda c: either(c["m"], _WORDED),
        "cue": lambda c: either(c["before"], PERSON_CUE),
        "opening": lambda c: either(c["before"], r"(?:^|[.!?\n]\s*)$"),
        "numbered": lambda c: either(c["before"], r"[0-9]\s$"),
        "words": lambda c: F.size(F.split(c["m"], " ")).cast("string"),
    },
)

# The last words of streets, and words before an address.
STREETS = "Street St Avenue Ave Road Rd Lane Ln Drive Dr Boulevard Blvd Court Ct Way Place Pl Square Sq Terrace Parkway Highway".split()
MONTHS = "January February March April May June July August September October November December".split()
PLACE_CUE = r"(?:\baddress(?: is|:)?|\blives? at|\blocated at|\breside[sd]? at|\bship to:?|\bmail to:?|\bhome:?)\s*$"
_STREET = r"\b(?:" + "|".join(STREETS) + r")\.?$"
_MONTH = r"^[0-9]+ (?:" + "|".join(MONTHS) + r")\b"
_ZIP = r"^,?\x20(?:[\p{L} ]{2,10},?\x20)?(?:[A-Z]{2}\x20)?[0-9]{4,5}"
ADDRESS = Learned(
    # a number and one to four capitalised words
    r"(?<![\p{L}\p{N}.,])[0-9]{1,5}(?:\x20\p{Lu}\p{Ll}++\.?){1,4}+(?![\p{L}\p{N}])",
    lambda t: t.rlike(r"[0-9]\x20\p{Lu}\p{Ll}"),
    {
        "street": lambda c: F.when(c["m"].rlike(_STREET), 1).when(c["m"].rlike(_MONTH), 0),
        "cue": lambda c: F.when(c["before"].rlike(PLACE_CUE), 1),
        "code": lambda c: F.when(c["after"].rlike(_ZIP), 1),
        "alone": lambda c: F.when(~c["m"].rlike(_STREET) & ~c["before"].rlike(PLACE_CUE), 0),
    },
    {
        "street": lambda c: either(c["m"], _STREET),
        "month": lambda c: either(c["m"], _MONTH),
        "cue": lambda c: either(c["before"], PLACE_CUE),
        "code": lambda c: either(c["after"], _ZIP),
        "words": lambda c: F.size(F.split(c["m"], " ")).cast("string"),
    },
)
LEARNED = {"secret": SECRET, "name": NAME, "address": ADDRESS}
KINDS = (*PATTERNS, *LEARNED)


# First rates of a labeler: of each vote (1, 0 or none) on a span of the kind and on another one.
VOTES = {1: (0.45, 0.05), 0: (0.05, 0.45), None: (0.5, 0.5)}
TRUST = 0.5  # the first rates stand for this share of the cases, so that a labeler keeps its sense
Rates = dict[int | None, tuple[float, float]]


def estimate(patterns: list[tuple[tuple, int]], rounds: int = 50) -> tuple[float, list[Rates]]:
    """Expectation-maximisation over (votes, count): the share of spans of the kind, and for each
    labeler the rates of its votes on them and on others.  Not to vote is a vote too, so labelers
    that only ever say yes tell something."""
    m = len(patterns[0][0])
    weight = 4.0 + TRUST * sum(n for _, n in patterns)
    prior, rates = 0.5, [dict(VOTES) for _ in range(m)]
    for _ in range(rounds):
        seen = [{v: [weight * p, weight * q] for v, (p, q) in VOTES.items()} for _ in range(m)]
        share, total = 1.0, 2.0
        for votes, count in patterns:
            q = posterior(votes, prior, rates)
            share, total = share + q * count, total + count
            for j, v in enumerate(votes):
                seen[j][v][0] += q * count
                seen[j][v][1] += (1 - q) * count
        prior = share / total
        sums = [tuple(sum(x[side] for x in s.values()) for side in (0, 1)) for s in seen]
        rates = [{v: (x[0] / n[0], x[1] / n[1]) for v, x in s.items()} for s, n in zip(seen, sums, strict=True)]
    return prior, rates


def posterior(votes: tuple, prior: float, rates: list[Rates]) -> float:
    odds = math.log(prior / (1 - prior)) + sum(math.log(r[v][0] / r[v][1]) for v, r in zip(votes, rates, strict=True))
    return 1 / (1 + math.exp(-min(max(odds, -500), 500)))


def train(found: DataFrame, kind: Learned) -> tuple[float, dict[str, dict[str, float]]] | None:
    """Log-odds prior and weights by feature value from candidates (column c); None if no
    labeler votes for the kind.  What reaches the driver is a count for each pattern of votes
    and each feature value."""
    names, features = list(kind.labelers), list(kind.features)
    votes = found.select(*[f(F.col("c")).cast("int").alias(k) for k, f in kind.labelers.items()], *[f(F.col("c")).alias(f"f_{k}") for k, f in kind.features.items()])
    votes = votes.where(F.coalesce(*names).isNotNull())
    grouped = votes.groupBy(*names).agg(F.count("*").alias("n")).collect()
    if not any(r[k] == 1 for r in grouped for k in names):
        return None
    prior, rates = estimate([(tuple(r[k] for k in names), r["n"]) for r in grouped])
    odds = F.lit(math.log(prior / (1 - prior)))
    for k, r in zip(names, rates, strict=True):
        weight = {v: math.log(p / q) for v, (p, q) in r.items()}
        odds = odds + F.when(F.col(k) == 1, weight[1]).when(F.col(k) == 0, weight[0]).otherwise(weight[None])
    # in thousandths, so that the order of partial sums doesn't matter
    soft = votes.withColumn("q", F.round(1000 / (1 + F.exp(-odds))).cast("long"))
    pairs = soft.select("q", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"f_{k}").alias("v")) for k in features])).alias("p"))
    table = pairs.groupBy("p.k", "p.v").agg(F.sum("q").alias("yes"), F.sum(1000 - F.col("q")).alias("no")).collect()
    yes, no = (sum(r[x] for r in table if r["k"] == features[0]) / 1000 for x in ("yes", "no"))
    sizes = {k: sum(r["k"] == k for r in table) for k in features}
    weights: dict[str, dict[str, float]] = {k: {} for k in features}
    for r in table:
        weights[r["k"]][r["v"]] = math.log((r["yes"] / 1000 + 0.5) / (yes + 0.5 * sizes[r["k"]])) - math.log((r["no"] / 1000 + 0.5) / (no + 0.5 * sizes[r["k"]]))
    return math.log((yes + 1) / (no + 1)), weights


def is_of(c: Column, kind: Learned, model: tuple[float, dict[str, dict[str, float]]]) -> Column:
    """The classifier as a column expression."""
    score = F.lit(model[0])
    for k, values in model[1].items():
        v = kind.features[k](c)
        w = F.lit(0.0)
        for value, weight in sorted(values.items()):
            w = F.when(v == value, weight).otherwise(w)
        score = score + w
    voted = F.lit(False)
    for f in kind.labelers.values():
        voted = voted | F.coalesce(f(c) == 1, F.lit(False))
    return score > F.when(voted, 0.0).otherwise(math.log(SURE / (1 - SURE)))


def listed(parts: list[tuple[str, Column]]) -> Column:
    """kind:start:end of all spans by start, then kind as listed, joined by commas."""
    ranked = lambda i, k, a: F.transform(a, lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("rank"), s["end"].alias("end"), F.lit(k).alias("kind")))
    all_ = F.concat(*[ranked(i, k, a) for i, (k, a) in enumerate(parts)])
    return F.array_join(F.transform(F.sort_array(all_), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def classified(kind: str, model: tuple[float, dict[str, dict[str, float]]] | None) -> Column:
    """The spans of a learned kind among the candidates in `found_<kind>`."""
    if model is None:
        return F.array().cast("array<struct<start:int,end:int,m:string>>").alias(kind)
    some = F.filter(f"found_{kind}", lambda c: is_of(c, LEARNED[kind], model))
    return F.transform(some, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["m"].alias("m"))).alias(kind)


def tagged(kind: str) -> Column:
    return F.transform(f"found_{kind}", lambda c: F.struct(F.lit(kind).alias("kind"), c.alias("c")))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, text, arrays of spans by kind, n_<kind>, base (as text) and spans (as text)."""
    d = base_spans(docs).select("*", *[k.candidates(F.col("text")).alias(f"found_{name}") for name, k in LEARNED.items()])
    each = F.concat(*[tagged(name) for name in LEARNED])
    held = materialised(d.select(F.explode(each).alias("x")).select("x.kind", "x.c"))
    models = {name: train(held.where(F.col("kind") == name), k) for name, k in LEARNED.items()}
    discard(held)
    d = d.select("doc_id", "text", *PATTERNS, *[classified(name, m) for name, m in models.items()])
    return d.select("*", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], listed([(k, F.col(k)) for k in PATTERNS]).alias("base"), listed([(k, F.col(k)) for k in KINDS]).alias("spans"))
