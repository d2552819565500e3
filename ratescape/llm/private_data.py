"""Personal data by weak supervision.

Four fixed patterns give the base spans: mail addresses, network addresses,
payment cards and phone numbers. Looser patterns propose further candidates. On
each candidate three labelers vote yes, no or nothing: a strict pattern, a
gazetteer (mail domains, card prefixes, reserved exchanges and the like) and the
words just before it. How reliable each labeler is per kind is estimated by
expectation-maximisation over the counts of vote patterns, without any labels.
The resulting probabilities train a classifier over votes and shape (logistic
regression), and the candidates it accepts are added as spans. Base spans stay.

Votes and shapes are small fixed sets, so their table has at most ``PATTERNS``
rows however large the corpus is; only these counts reach the driver. Texts are
searched and judged with DataFrame functions.

Null text is empty and has no spans. Without any candidate nothing is trained
and nothing added. Rows are documents, also with equal or null ids.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratescape.llm import spans
from ratescape.llm.common import stored

#: The kinds and their patterns.
KINDS = ("email", "ip", "card", "phone")
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Mail addresses and cards hold groups that repeat without bound, on which Java's engine recurses until its stack is
#: full. So the marks that may not stand inside a match (a dot without a name character on both sides, a blank or hyphen
#: without digits) are replaced first by characters of no class, and what is left are runs of a class. A match begins where a
#: run or the last match ends: from any later place in a run the rest would be the same, so nothing is tried twice.
NO_DOT, NO_JOIN = r"(?<![A-Za-z0-9-])\.|\.(?![A-Za-z0-9-])", r"(?<![0-9])[\x20-]|[\x20-](?![0-9])"
EMAIL = r"(?:(?<![A-Za-z0-9._%+\x01-])|\G)[A-Za-z0-9._%+\x01-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++"
CARD = r"[0-9][0-9\x20-]++"
LEAST_CARD = r"(?:[0-9][\x20-]?){12}"
#: Looser candidates of the same kinds.
LOOSE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++ ?(?:\[at\]|\(at\)|@) ?[A-Za-z0-9-]++ ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z]{2,}",
    "card": r"(?<![0-9.])[0-9]{4}(?:[ ./_-]?[0-9]{4}){2}[ ./_-]?[0-9]{3,4}(?![0-9])",
    "phone": r"(?<![0-9+.])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
#: Gazetteers: what the value of a kind starts or ends with when it is a likely one.
MAIL_ENDS = r"(?i)(?:\.|\[dot\]|\(dot\)) ?(?:com|org|net|edu|gov|io|de|fr|es|uk|eu|info)$"
CARD_STARTS, PRIVATE_NETS = "^(?:4|5[1-5]|3[47]|6011|65)", r"^(?:0|127|255)\."
PHONE_NO = r"^\(?(?:000|123|999)"
#: Words before a value, within ``BEFORE`` characters, that speak for or against its kind.
BEFORE = 32
SPEAKS = {
    "email": "(?i)(?:e-?mail|contact|write to|kontakt|correo|courriel)[^.!?]*$",
    "ip": r"(?i)(?:\bip\b|host|address|server|client|login)[^!?]*$",
    "card": "(?i)(?:card|visa|mastercard|payment|karte|tarjeta|carte)[^.!?]*$",
    "phone": r"(?i)(?:phone|call|tel\b|mobile|fax|contact|telefon|tel[eé]fono)[^.!?]*$",
}
AGAINST = r"(?i)(?:version|release|build|isbn|issue|invoice|order|serial|\bv)[^a-z]*$"
#: kinds x base or not x three labelers with three votes x four shapes.
PATTERNS = 4 * 2 * 27 * 4
ACCEPT, ROUNDS, STEPS = 0.9, 50, 400


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check sum of a digit string is right."""
    at = F.sequence(F.lit(1), F.length(digits))

    def add(total, i):
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int") * (2 - i % 2)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(at, F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> Column:
    whole = lambda s: F.forall(F.split(s["value"], r"\."), lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    size = lambda s: F.length(_digits(s["value"]))
    card = lambda s: F.when(size(s).between(12, 19), luhn(_digits(s["value"]))).otherwise(F.lit(False))
    dots = F.regexp_replace(F.translate(text, "\x01", "\x02"), NO_DOT, "\x01")
    mails = F.transform(spans.find(dots, EMAIL, "email", 0), lambda s: s.withField("value", F.translate(s["value"], "\x01", ".")))
    cards = spans.find(F.regexp_replace(text, NO_JOIN, "\x01"), CARD, "card", 2)
    return F.concat(
        F.when(text.contains("@"), mails).otherwise(spans.none()),
        F.filter(spans.find(text, IP, "ip", 1), whole),
        F.when(text.rlike(LEAST_CARD), F.filter(cards, card)).otherwise(spans.none()),
        F.filter(spans.find(text, PHONE, "phone", 3), lambda s: size(s).between(9, 15)),
    )


def _votes(text: Column, s: Column, strict: Column) -> Column:
    """kind:strict:pattern:gazetteer:context:shape of a candidate; votes are y, n or -."""
    value, kind = s["value"], s["kind"]
    before = F.substring(text, F.greatest(s["start"] - BEFORE, F.lit(0)) + 1, F.least(s["start"], F.lit(BEFORE)))
    digits = _digits(value)
    vote = lambda yes, no: F.when(yes, "y").when(no, "n").otherwise("-")
    never = F.lit(False)

    def by_kind(email, ip, card, phone):
        return F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).otherwise(phone)

    checked = F.length(digits).between(12, 19) & luhn(digits)
    pattern = by_kind(
        vote(value.rlike("^[^ ]+@[^ ]+$"), value.rlike(r"\.\.|^\.")), vote(strict, ~strict), vote(checked, ~checked), vote(F.length(digits).between(10, 15), F.length(digits) < 9)
    )
    gazetteer = by_kind(
        vote(value.rlike(MAIL_ENDS), never), vote(never, value.rlike(PRIVATE_NETS)), vote(digits.rlike(CARD_STARTS), ~digits.rlike("^[3-6]")), vote(never, value.rlike(PHONE_NO))
    )
    speaks = by_kind(*(before.rlike(SPEAKS[k]) for k in KINDS))
    context = vote(speaks, before.rlike(AGAINST))
    shape = F.when(value.contains(" "), "s").when(value.contains("-"), "h").when(value.rlike(r"[(\[/_]"), "b").otherwise("p")
    return F.concat_ws(":", kind, F.when(strict, "base").otherwise("loose"), pattern, gazetteer, context, shape)


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def label_model(counts: dict[str, int], kind: str) -> dict[str, float]:
    """Probability that a candidate of the kind is personal data, per vote pattern: one rate of yes and no votes per labeler and class."""
    rows = [(p, p.split(":")[2:5], n) for p, n in sorted(counts.items()) if p.split(":")[0] == kind]
    prior = 0.5
    # to start, yes votes are right nine times in ten, and so are no votes
    rate = {(k, c, v): {"y": 0.6 if c else 0.06, "n": 0.06 if c else 0.6, "-": 0.34}[v] for k in range(3) for c in (0, 1) for v in "yn-"}
    post = {}
    for _ in range(ROUNDS):
        for p, votes, _n in rows:
            odds = math.log(prior / (1 - prior)) + sum(math.log(rate[k, 1, v] / rate[k, 0, v]) for k, v in enumerate(votes))
            post[p] = _sigmoid(odds)
        total = {c: sum(n * (post[p] if c else 1 - post[p]) for p, _, n in rows) for c in (0, 1)}
        prior = min(0.98, max(0.02, (total[1] + 1) / (total[0] + total[1] + 2)))
        for k in range(3):
            for c in (0, 1):
                for v in "yn-":
                    seen = sum(n * (post[p] if c else 1 - post[p]) for p, votes, n in rows if votes[k] == v)
                    prior_rate = {"y": 0.6 if c else 0.06, "n": 0.06 if c else 0.6, "-": 0.34}[v]
                    rate[k, c, v] = (seen + 5 * prior_rate) / (total[c] + 5)
    return post


def _features(pattern: str) -> list[str]:
    kind, _, *votes, shape = pattern.split(":")
    return [kind, *(f"{kind}{k}{v}" for k, v in enumerate(votes)), f"{kind}{shape}"]


def train(counts: dict[str, int]) -> dict[str, float]:
    """Accepted probability of every pattern: logistic regression on the label model's probabilities, weighted by counts."""
    soft: dict[str, float] = {}
    for kind in KINDS:
        soft |= label_model(counts, kind)
    weights: dict[str, float] = {}
    largest = math.log1p(max(counts.values(), default=1))
    rows = [(_features(p), soft[p], math.log1p(n) / largest) for p, n in sorted(counts.items())]
    for step in range(STEPS):
        gradient: dict[str, float] = {}
        for names, y, n in rows:
            error = n * (y - _sigmoid(sum(weights.get(f, 0.0) for f in names)))
            for f in names:
                gradient[f] = gradient.get(f, 0.0) + error
        for f, g in gradient.items():
            weights[f] = weights.get(f, 0.0) * (1 - 1e-3) + g / (1 + step / 100)
    return {p: _sigmoid(sum(weights.get(f, 0.0) for f in _features(p))) for p in counts}


def candidates(docs: DataFrame) -> DataFrame:
    """_row, doc_id, _base and _loose spans with the votes on each, stored without the text."""
    text = F.coalesce("text", F.lit(""))
    loose = F.concat(*(spans.find(F.col("_text"), p, kind, KINDS.index(kind)) for kind, p in LOOSE.items()))
    rows = docs.select("doc_id", text.alias("_text"), base_spans(text).alias("_base"))
    rows = rows.withColumn("_loose", spans.apart(loose, F.col("_base")))
    voted = lambda s, strict: F.struct(s.alias("span"), _votes(F.col("_text"), s, F.lit(strict)).alias("votes"))
    rows = rows.select("doc_id", F.transform("_base", lambda s: voted(s, True)).alias("_base"), F.transform("_loose", lambda s: voted(s, False)).alias("_loose"))
    return stored(rows, "private-candidates")


def find_private(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """Per document: doc_id, _base and _all spans; the added ones are those the classifier accepts."""
    found = candidates(docs)
    patterns = found.select(F.explode(F.concat("_base", "_loose")).alias("c")).groupBy("c.votes").agg(F.count(F.lit(1)).alias("n"))
    counts = {r.votes: r.n for r in patterns.collect()}  # at most PATTERNS rows
    fine = sorted(p for p, x in train(counts).items() if x >= accept and p.split(":")[1] == "loose")
    added = F.filter("_loose", lambda c: c["votes"].isin(fine)) if fine else F.filter("_loose", lambda c: F.lit(False))
    only = lambda c: c["span"]
    base = F.transform("_base", only)
    return found.select("doc_id", base.alias("_base"), F.concat(base, F.transform(added, only)).alias("_all"))
