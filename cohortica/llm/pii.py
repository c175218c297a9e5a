r"""Personal data by weak supervision.

Labelers of three kinds vote on candidate spans: regular expressions (does the
span have a strict form), gazetteers (does it bear a known provider, domain, issuer or
area, or is it a known placeholder) and context (what stands next to it). A
label model estimates by expectation-maximisation how reliable each labeler is,
without any labelled row; its posteriors then train a logistic span classifier
on the spans' own shape, which decides on the spans that the base rules leave
open.

The patterns are written so that a regular-expression engine that backtracks
stays linear in the text: what can begin a match is asserted, and runs are
possessive. Candidates are found in one pass over the text; votes and features
are small integers, so that all that is known of the corpus fits a table of
patterns with counts, of which there is a fixed number of combinations.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortica.llm.common import cut_text, let, materialise, running, text_between, text_of

KINDS = ("email", "ip", "card", "phone")

_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"

#: Base: kind -> pattern. \G keeps matches that begin where the last one ended.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: Wider candidates that the base rules don't decide: kind -> pattern.
WIDE = {
    # written-out signs, in brackets or as words
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++(?:\x20?[\[(]\x20?at\x20?[\])]\x20?{_HOST}++(?:(?:\.|\x20?[\[(]\x20?dot\x20?[\])]\x20?){_HOST}++)++|\x20at\x20{_HOST}++(?:\x20dot\x20{_HOST}++)++)",
    # a number of usual grouping, whatever digits stand a blank away, or any run of 12 to 19 digits
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{4}\x20[0-9]{4}\x20[0-9]{4}\x20[0-9]{4}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}|[0-9]{13,19}|[0-9](?:[\x20-]?[0-9]){11,18}+)(?![0-9A-Za-z])",
    # area code and number; a trunk 0 and one or two groups, or five pairs; an international number after 00
    "phone": r"(?<![0-9A-Za-z+.-])(?:(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}|0[1-9](?:[\x20.-][0-9]{2}){4}|0[1-9][0-9]{1,3}[\x20/-][0-9]{5,8}|00[1-9][0-9]{0,2}(?:[\x20.-][0-9]{2,4}){3,4})(?![0-9A-Za-z]|[\x20/.-]?[0-9])",
}

#: Words that announce a kind, lower case.
CONTEXT = {
    "email": "e-?mail|mail|contact|correo|courriel|kontakt|write|@",
    "ip": "ip|address|host|server|adresse|direcci[oó]n",
    "card": "card|credit|visa|mastercard|amex|carte|tarjeta|karte|payment|account|konto|compte|cuenta",
    "phone": "phone|tel|call|mobile|cell|fax|telefon|t[eé]l[eé]phone|tel[eé]fono|appel|llam",
}

#: What is no one's data.
PLACEHOLDERS = {"email": r"@example\.(?:invalid|test)$", "ip": r"^(?:0\.0\.0\.0|127\.0\.0\.1|255\.255\.255\.255)$", "card": r"^(?:0[\x20-]?){12,}$|^(?:1234[\x20-]?){3,}", "phone": r"^[^1-9]*$|^(?:[^0-9]*(?:123|1234|0000)){3,}"}

#: Names that real data of a kind bears: mail providers and top-level domains, networks that are not reserved, issuers' first digits, calling and area codes.
GAZETTEER = {
    "email": r"(?i)(?:gmail|googlemail|yahoo|hotmail|outlook|live|icloud|aol|gmx|web|mail|proton|protonmail|orange|free|laposte|t-online|terra|telefonica)[^A-Za-z]|(?:\.|dot\x20?[\])]?\x20?)(?:com|org|net|edu|gov|info|io|eu|de|fr|es|uk|it|nl|at|ch|be|pl|us|ca|mx|ar|co|br)$",
    "ip": r"^(?:[1-9]|[1-9][0-9]|1[01][0-9]|12[0-6]|12[89]|1[3-9][0-9]|2[01][0-9]|22[0-3])\.",
    "card": r"^(?:4|5[\x20-]?[1-5]|2[\x20-]?[2-7]|3[\x20-]?[47]|6[\x20-]?(?:0[\x20-]?1[\x20-]?1|4[\x20-]?[4-9]|5))",
    "phone": r"^(?:\+|00)(?:1|7|20|27|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})|^0[1-9]|^\(?[2-9][0-9]{2}\)?[\x20.-]",
}

#: Characters before a candidate that the context labeler reads.
BEFORE = 24
LABELERS = 5
SHAPES = 5
#: Which labeler is a checksum: kind -> labeler.
CHECKSUM = {2: 1}


def _found(text: Column, pattern: str) -> Column:
    """Array of (start, span, left, after): the match, up to BEFORE characters in front of it and the one behind it.

    What lies between matches is as long as split says, so no position is
    searched again, and what stands beside a match is taken from its neighbours:
    the text is never read from its front for one span.
    """
    spans = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    kind = "array<struct<start:int,span:string,left:string,after:string>>"

    def placed(found: Column) -> Column:
        def of_gaps(gaps: Column) -> Column:
            lengths = F.transform(found, lambda x, i: F.length(F.get(gaps, i)) + F.length(x))
            # a match has a character at least, so BEFORE pieces reach back far enough
            tails = F.transform(found, lambda x, i: F.right(F.concat(F.get(gaps, i), x), F.lit(BEFORE)))

            def described(starts: Column, tails: Column) -> Column:
                def one(x: Column, i: Column) -> Column:
                    gap = F.get(gaps, i)
                    past = F.slice(tails, F.greatest(i - BEFORE, F.lit(0)) + 1, F.least(i, F.lit(BEFORE)))
                    left = F.right(F.concat(F.array_join(past, ""), F.right(gap, F.lit(BEFORE))), F.lit(BEFORE))
                    after = F.substr(F.concat(F.get(gaps, i + 1), F.coalesce(F.get(found, i + 1), F.lit(""))), F.lit(1), F.lit(1))
                    return F.struct((F.get(starts, i) + F.length(gap)).alias("start"), x.alias("span"), left.alias("left"), after.alias("after"))

                return F.transform(found, one)

            begun = lambda n: running(n, lambda a, b: a + b, 0)
            return let(F.struct(lengths.alias("n"), tails.alias("t")), lambda x: let(F.struct(begun(x["n"]).alias("s"), x["t"].alias("t")), lambda y: described(y["s"], y["t"])))

        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), of_gaps)).otherwise(F.array().cast(kind))

    return let(spans, placed)


def _apart(wide: Column, base: Column) -> Column:
    """Those of wide that no span of base overlaps; each list is in order and without overlap.

    Of all base spans that begin before a wide one ends, the last reaches furthest: one running greatest end decides.
    """
    event = lambda at, of: F.struct(at.alias("at"), of.alias("of"))
    # at one place a wide span's end comes before a base span's start
    events = F.sort_array(F.concat(F.transform(wide, lambda x: event(x["end"], F.struct(F.lit(False).alias("base"), x.alias("span")))), F.transform(base, lambda x: event(x["start"], F.struct(F.lit(True).alias("base"), x.alias("span"))))))

    def free(e: Column) -> Column:
        ends = F.transform(e, lambda x: F.when(x["of"]["base"], x["of"]["span"]["end"]).otherwise(-1))
        return let(let(ends, lambda x: running(x, F.greatest, -1)), lambda r: F.transform(F.filter(e, lambda x, i: ~x["of"]["base"] & (F.get(r, i) <= x["of"]["span"]["start"])), lambda x: x["of"]["span"]))

    return F.when((F.size(wide) > 0) & (F.size(base) > 0), let(events, free)).otherwise(wide)


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]+", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes."""
    n = F.length(number)

    def add(acc: Column, i: Column) -> Column:
        d = F.substr(number, n - i, F.lit(1)).cast("int")
        return acc + F.when(i % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def base_holds(kind: str, span: Column) -> Column:
    """Whether a match of the base pattern counts."""
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
        return span.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return let(digits(span), lambda d: F.length(d).between(16, 19) & F.when(F.length(d).between(16, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(digits(span)).between(8, 15)
    return F.lit(True)


def _strict(kind: str, span: Column) -> Column:
    """The regex labeler: -1, 0 or 1."""
    if kind == "email":
        return F.when(span.rlike(r"\.[A-Za-z]{2,}$"), 1).otherwise(0)
    if kind == "ip":
        return F.when(span.rlike(r"^(?:[1-9][0-9]{0,2}|0)(?:\.(?:[1-9][0-9]{0,2}|0)){3}$"), 1).otherwise(-1)
    if kind == "card":
        return F.when(span.rlike(r"^(?:[0-9]{13,19}|(?:[0-9]{4}[\x20-]){3}[0-9]{1,7}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})$"), 1).otherwise(-1)
    return F.when(span.rlike(r"^(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[\x20.-]?[0-9]{2,4}){2,4}$"), 1).otherwise(-1)


def _checked(kind: str, span: Column) -> Column:
    """The checksum labeler of cards, the length labeler of phones and addresses."""
    d = digits(span)
    if kind == "card":
        return let(d, lambda x: F.when(~F.length(x).between(13, 19), -1).when(luhn(x), 1).otherwise(-1))
    if kind == "phone":
        return F.when(F.length(d).between(9, 13), 1).otherwise(-1)
    if kind == "ip":
        return F.when(base_holds("ip", span), 1).otherwise(-1)
    return F.when(F.length(span) <= 64, 1).otherwise(-1)


def candidates(docs: DataFrame) -> DataFrame:
    """docs with spans: array of kind (index), start, end, base, votes, shape, by kind and start. Native functions only.

    votes: five votes of -1, 0 or 1 in base 3; shape: five features of the span
    itself in base 4. A wide candidate that touches a base span of its kind is
    left to that.
    """
    text = text_of()

    def described(kind: str, found: Column, base: bool, at: int) -> Column:
        def one(x: Column) -> Column:
            span, start = x["span"], x["start"]
            end = start + F.length(span)
            left = F.lower(x["left"])
            free = ~(F.concat(F.right(x["left"], F.lit(1)), F.lit(" "), x["after"]).rlike(r"[0-9A-Za-z]"))
            votes = (
                _strict(kind, span),
                _checked(kind, span),
                F.when(left.rlike(rf"(?<![a-z])(?:{CONTEXT[kind]})"), 1).otherwise(0),
                F.when(span.rlike(PLACEHOLDERS[kind]), -1).when(span.rlike(GAZETTEER[kind]), 1).otherwise(0),
                F.when(free, 1).otherwise(-1),
            )
            n = F.length(digits(span))
            shape = (
                F.least(F.floor(n / 5), F.lit(3)),
                F.least(F.length(F.regexp_replace(span, r"[^\x20().-]+", "")), F.lit(3)),
                F.least(F.floor(F.length(span) / 12), F.lit(3)),
                F.when(span.startswith("+"), 1).otherwise(0) + F.when(span.contains("("), 2).otherwise(0),
                F.when(base_holds(kind, span), 1).otherwise(0) + F.when(F.lit(base), 2).otherwise(0),
            )
            coded = lambda values, radix: sum(((v + int(radix == 3)).cast("int") * radix**i for i, v in enumerate(values)), F.lit(0))
            return F.struct(F.lit(at).alias("kind"), start.alias("start"), end.alias("end"), F.lit(base).alias("base"), coded(votes, 3).alias("votes"), coded(shape, 4).alias("shape"))

        return F.transform(found, one)

    # in three steps, whose columns are the few spans of a text
    prefix = "pii"
    while any(c.lower().startswith(f"{prefix}_") for c in docs.columns):
        prefix += "x"
    held = {(kind, base): f"{prefix}_{kind}_{'base' if base else 'wide'}" for base, of in ((True, BASE), (False, WIDE)) for kind in of}
    holding = lambda kind, c: F.filter(c, lambda x: base_holds(kind, x["span"]))
    found = docs.withColumns({c: _found(text, (BASE if base else WIDE)[kind]) for (kind, base), c in held.items()})
    named = found.withColumns({c: described(kind, holding(kind, c) if base else F.col(c), base, KINDS.index(kind)) for (kind, base), c in held.items()})
    merged = lambda b, w: F.sort_array(F.concat(b, _apart(F.col(w), F.col(b))))
    sets = [merged(held[k, True], held[k, False]) if k in WIDE else F.col(held[k, True]) for k in KINDS]
    return named.withColumn("spans", F.concat(*sets)).drop(*held.values())


@dataclass
class LabelModel:
    """P(vote | kind, real) of each labeler, and P(real | kind)."""

    table: dict[tuple[int, int, bool, int], float]
    prior: dict[int, float]

    def posterior(self, kind: int, votes: tuple[int, ...]) -> float:
        log = math.log(self.prior[kind] / (1 - self.prior[kind])) + sum(math.log(self.table[kind, i, True, v] / self.table[kind, i, False, v]) for i, v in enumerate(votes))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, log))))


def unpack(code: int, radix: int, n: int) -> tuple[int, ...]:
    return tuple(code // radix**i % radix for i in range(n))


def fit_labels(patterns: dict[tuple[int, int], int], rounds: int = 40) -> LabelModel:
    """Expectation-maximisation over (kind, votes) -> count: labelers vote independently given what is real.

    It starts from the majority of the votes, but for numbers that fail a
    checksum, which start as not real; every table is estimated from there.
    Counts are smoothed, so a labeler that never speaks, or a kind that never
    occurs, is neither for nor against.
    """
    votes = {k: unpack(k[1], 3, LABELERS) for k in patterns}
    real = {k: 0.05 if CHECKSUM.get(k[0]) is not None and votes[k][CHECKSUM[k[0]]] == 0 else min(0.9, max(0.1, 0.5 + 0.15 * sum(v - 1 for v in votes[k]))) for k in patterns}
    model = LabelModel({}, {})
    for _ in range(rounds):
        total = {(kind, y): 1.0 for kind in range(len(KINDS)) for y in (True, False)}
        seen = {(kind, i, y, v): 1.0 / 3 for kind in range(len(KINDS)) for i in range(LABELERS) for y in (True, False) for v in range(3)}
        for (kind, code), n in patterns.items():
            for y, p in ((True, real[kind, code]), (False, 1 - real[kind, code])):
                total[kind, y] += n * p
                for i, v in enumerate(votes[kind, code]):
                    seen[kind, i, y, v] += n * p
        model = LabelModel({k: x / total[k[0], k[2]] for k, x in seen.items()}, {kind: total[kind, True] / (total[kind, True] + total[kind, False]) for kind in range(len(KINDS))})
        real = {k: model.posterior(k[0], votes[k]) for k in patterns}
    return model


def fit_spans(rows: dict[tuple[int, int, int], int], model: LabelModel, rounds: int = 300, rate: float = 1.0) -> dict[tuple, float]:
    """Weights of a logistic classifier over (kind), (kind, feature, value) and (kind, labeler, vote), trained on the label model's posteriors.

    rows: (kind, votes, shape) -> count, one for each combination that occurs.
    """
    known: dict[tuple, int] = {}
    cases = sorted(rows)
    at = np.array([[known.setdefault(k, len(known)) for k in ((kind,), *((kind, "shape", i, v) for i, v in enumerate(unpack(shape, 4, SHAPES))), *((kind, "vote", i, v) for i, v in enumerate(unpack(votes, 3, LABELERS))))] for kind, votes, shape in cases])
    want = np.array([model.posterior(kind, unpack(votes, 3, LABELERS)) for kind, votes, _ in cases])
    n, kinds = np.array([rows[c] for c in cases], float), np.array([c[0] for c in cases])
    share = n / np.bincount(kinds, n, len(KINDS))[kinds]
    weights = np.zeros(len(known))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(weights[at].sum(axis=1), -50, 50)))
        step = np.bincount(at.reshape(-1), np.repeat(share * (want - p), at.shape[1]), len(known))
        weights = 0.999 * weights + rate * step / 2
    return {k: float(weights[i]) for k, i in known.items()}


def score_span(weights: dict[tuple, float], span: Column) -> Column:
    """The classifier as one expression: a lookup of each digit of votes and shape in a constant array."""
    out = F.lit(0.0)
    for kind in range(len(KINDS)):
        one = F.lit(weights.get((kind,), 0.0))
        for name, radix, n in (("shape", 4, SHAPES), ("vote", 3, LABELERS)):
            code = span["shape" if name == "shape" else "votes"]
            for i in range(n):
                values = F.array(*[F.lit(weights.get((kind, name, i, v), 0.0)) for v in range(radix)])
                one = one + F.get(values, (F.floor(code / radix**i) % radix).cast("int"))
        out = F.when(span["kind"] == kind, one).otherwise(out)
    return 1 / (1 + F.exp(-out))


def find(docs: DataFrame, threshold: float = 0.5, columns: list[str] | None = None) -> DataFrame:
    """docs (or only the named columns of it) with spans: array of kind, start, end, base, by kind (as in KINDS), then start; offsets in code points.

    Base spans always stay; of the wider ones those stay that the classifier
    gives more than the threshold. A null text is the empty one and has no span.
    Nulls elsewhere, repeated rows and further columns pass through; a column
    named spans is replaced. Without candidates nothing is trained.
    """
    named = candidates(docs)
    held = materialise(named.select(*columns, "spans") if columns is not None else named)
    counts = held.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.votes", "s.shape").agg(F.count("*").alias("n")).collect()
    rows = {(r["kind"], r["votes"], r["shape"]): r["n"] for r in counts}  # of a fixed number of combinations at most
    patterns: dict[tuple[int, int], int] = {}
    for (kind, votes, _), n in rows.items():
        patterns[kind, votes] = patterns.get((kind, votes), 0) + n
    weights = fit_spans(rows, fit_labels(patterns)) if rows else {}
    kept = F.filter("spans", lambda s: s["base"] | (score_span(weights, s) > threshold))
    names = F.array(*map(F.lit, KINDS))
    return held.withColumn("spans", F.transform(kept, lambda s: F.struct(F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"))))


def redact(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """docs with each span of text replaced by its kind in brackets, as [EMAIL]; overlapping spans become one, named by the first.

    Texts without spans stay as they are, null ones too; n_chars, if there, is counted anew.
    All other columns stay, one named spans too.
    """
    own = next((c for c in docs.columns if c.lower() == "spans"), None)
    aside = "spans_aside"
    while aside in {c.lower() for c in docs.columns}:
        aside += "_"
    found = find(docs.withColumnRenamed(own, aside) if own else docs, threshold)

    text = F.col("text")
    in_order = F.array_sort("spans", lambda l, r: F.when(l["start"] != r["start"], l["start"] - r["start"]).otherwise(l["end"] - r["end"]))
    found = found.withColumn("spans", in_order)

    def written(pieces: Column) -> Column:
        # a span that begins inside those before it only lengthens them
        def heads(reach: Column) -> Column:
            named = F.transform("spans", lambda s, i: F.struct(F.get(reach, i).alias("since"), s["start"].alias("start"), s["kind"].alias("kind")))
            return F.array_join(F.transform(F.filter(named, lambda s: s["start"] >= s["since"]), lambda s: F.concat(text_between(pieces, s["since"], s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))), "")

        ends = F.transform("spans", lambda s: s["end"])
        return F.concat(let(let(ends, lambda x: running(x, F.greatest, 0)), heads), text_between(pieces, F.array_max(ends), F.length(text)))

    whole = let(cut_text(text), written)
    out = found.withColumn("text", F.when(F.size("spans") > 0, whole).otherwise(F.col("text"))).drop("spans")
    out = out.withColumnRenamed(aside, own) if own else out
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
