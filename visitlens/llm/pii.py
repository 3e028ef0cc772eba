"""Personal data in texts: patterns propose spans, checksums confirm them, context moves the score.

All work is SQL expressions. Positions come from splitting a text by the pattern: the pieces between
matches and the matches themselves, in turn, give every start. A pattern may start only where the
previous character cannot belong to the match (or right after the previous match), and loops never
give back, so matching is linear in the text and needs no stack, however long a run of digits is; the
matches of the base kinds are those of the plain pattern. An account number ends where its checksum says:
at each start the longest run is taken, and its prefixes that end at a word end are tested, that of the
country's length first, then from the longest to the shortest.

Base kinds: email, ip (parts at most 255), card (16 to 19 digits, Luhn), phone (8 to 15 digits). Added
kinds: iban (15 to 34 characters, mod 97) and ssn (three, two and four digits; kept only if the score
reaches ``MIN_SCORE``, that is with a context word near by). A span's score is its kind's base plus
``CONTEXT_GAIN`` if a context word of the kind stands within ``CONTEXT_CHARS`` characters.

Defined results: a null or empty text has no spans; spans count code points; repeated rows and null ids
keep their rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SCORE = 0.6
CONTEXT_GAIN = 0.3
CONTEXT_CHARS = 40


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _characters(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def luhn(value: Column) -> Column:
    """The last digit closes the Luhn sum: every second digit from the right counts double."""
    numbers = F.reverse(F.transform(_characters(digits(value)), lambda c: c.cast("int")))
    doubled = F.transform(numbers, lambda d, i: F.when(i % 2 == 0, d)
                          .when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(value: Column) -> Column:
    """The account number leaves 1 when read as a number with its first four characters at the end."""

    def check(plain: Column) -> Column:
        turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
        numbers = F.transform(_characters(turned), lambda c: F.when(
            c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55))
        return F.aggregate(numbers, F.lit(0), lambda a, n: F.when(
            n < 10, (a * 10 + n) % 97).otherwise((a * 100 + n) % 97)) == 1

    return _let(F.replace(value, F.lit(" "), F.lit("")), check)


IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
IBAN_RUN = r"^[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+"
IBAN_CHARS = 4 + 2 * 30  # of the longest run, with a blank before each character after the fourth
NO_SPANS = "array<struct<start:int,end:int,match:string>>"


def _ibans(text: Column, starts: Column) -> Column:
    """The valid account numbers at the starts, none of which overlap: those of their country's length first."""
    country = F.create_map(*[F.lit(x) for n, names in IBAN_LENGTHS.items() for name in names.split() for x in (name, n)])

    def plain(match: Column) -> Column:
        return F.length(F.replace(match, F.lit(" "), F.lit("")))

    def fixed(match: Column) -> Column:
        return F.coalesce(plain(match) == F.try_element_at(country, F.substring(match, 1, 2)), F.lit(False))

    def longest(start: Column) -> Column:
        def valid_prefix(near: Column) -> Column:
            run = F.regexp_extract(near, IBAN_RUN, 0)
            ends = F.filter(F.sequence(F.length(run), F.lit(15), F.lit(-1)), lambda n: ~F.substring(
                near, n, F.lit(2)).rlike("^(?: |.[A-Za-z0-9])"))
            valid = F.filter(F.transform(ends, lambda n: F.substring(near, F.lit(1), n)),
                             lambda m: plain(m).between(15, 34) & mod97(m))
            return F.when(F.length(run) >= 15, _let(valid, lambda v: F.get(F.concat(F.filter(v, fixed), v), F.lit(0))))

        match = _let(F.substring(text, start["start"] + 1, F.lit(IBAN_CHARS + 1)), valid_prefix)
        return _let(match, lambda m: F.struct(start["start"].alias("start"), (
            start["start"] + F.length(m)).alias("end"), m.alias("match")))

    def in_turn(spans: Column) -> Column:
        return F.aggregate(spans, F.array().cast(NO_SPANS), lambda kept, s: F.when(
            F.coalesce(F.try_element_at(kept, F.lit(-1))["end"], F.lit(0)) <= s["start"],
            F.concat(kept, F.array(s))).otherwise(kept))

    def apart(valid: Column) -> Column:
        return _let(in_turn(F.filter(valid, lambda s: fixed(s["match"]))), lambda first: F.array_sort(F.concat(
            first, in_turn(F.filter(valid, lambda s: ~fixed(s["match"]) & ~F.exists(
                first, lambda f: (f["start"] < s["end"]) & (s["start"] < f["end"])))))))

    return _let(F.filter(F.transform(starts, longest), lambda s: s["match"].isNotNull()), apart)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: Callable[[Column], Column]  # false only where the pattern cannot match
    valid: Callable[[Column], Column]
    base: float
    words: str  # context, lower case
    added: bool = False
    refined: Callable[[Column, Column], Column] = lambda text, spans: spans  # text, spans to valid spans


KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda t: F.contains(t, F.lit("@")), lambda m: F.lit(True), 0.9, "mail|contact|write|correo|courriel"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda t: F.contains(t, F.lit(".")),
         lambda m: F.forall(F.split(m, r"\."), lambda p: F.coalesce(p.try_cast("int"), F.lit(999)) <= 255),
         0.6, "ip|host|address|server|adresse"),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", lambda t: t.rlike("[0-9][0-9 -]{8}"),
         lambda m: F.length(digits(m)).between(16, 19) & luhn(m), 0.7, "card|visa|credit|karte|tarjeta|carte"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: F.contains(t, F.lit("+")),
         lambda m: F.length(digits(m)).between(8, 15), 0.6, "phone|call|tel|mobile|fax|appel"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z](?=[A-Z][0-9]{2}(?:\x20?[A-Z0-9]){11})",
         lambda t: t.rlike("[A-Z]{2}[0-9]{2}"), lambda m: F.lit(True), 0.7, "iban|account|bank|konto|cuenta|compte",
         True, _ibans),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         lambda t: t.rlike("[0-9]{3}-[0-9]{2}-"), lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$"),
         0.4, "ssn|social|security|tax", True),
)


def _proposed(text: Column, pattern: str) -> Column:
    """All matches as (start, end, match), in turn."""
    # struct(so far, next position), over pieces and matches
    state = F.struct(F.lit(0).alias("at"), F.array().cast(NO_SPANS).alias("spans"))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["piece"])
        end = start + F.coalesce(F.length(pair["match"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("match"))
        return F.struct(end.alias("at"), F.when(
            pair["match"].isNotNull(), F.concat(state["spans"], F.array(span)))
            .otherwise(state["spans"]).alias("spans"))

    def spans(matches: Column) -> Column:
        pairs = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), matches.alias("match"))
        return F.aggregate(pairs, state, step, lambda s: s["spans"])

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                lambda m: F.when(F.size(m) > 0, spans(m)).otherwise(F.array().cast(NO_SPANS)))


def _scored(text: Column, kind: Kind, spans: Column) -> Column:
    def score(span: Column) -> Column:
        low = F.greatest(span["start"] - CONTEXT_CHARS, F.lit(0))
        before = F.substring(text, low + 1, span["start"] - low)
        after = F.substring(text, span["end"] + 1, F.lit(CONTEXT_CHARS))
        near = F.lower(F.concat_ws(" ", before, after)).rlike(rf"(?<![a-z])(?:{kind.words})(?![a-z])")
        return F.struct(span["start"].alias("start"), span["end"].alias("end"),
                        (F.lit(kind.base) + F.when(near, CONTEXT_GAIN).otherwise(0.0)).alias("score"))

    scored = F.transform(F.filter(spans, lambda s: kind.valid(s["match"])), score)
    return F.filter(scored, lambda s: s["score"] >= MIN_SCORE) if kind.added else scored


def find_personal_data(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text and one column of (start, end, score) spans per kind."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    none = F.array().cast("array<struct<start:int,end:int,score:double>>")
    t = F.col("text")
    return rows.select("doc_id", "text", *[
        F.when(kind.hint(t), _scored(t, kind, kind.refined(t, _proposed(t, kind.pattern)))).otherwise(none).alias(kind.name)
        for kind in KINDS])


def span_digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, all spans as text, and the highest score."""

    def of_kind(name: str) -> Column:
        return F.transform(name, lambda s: F.concat_ws(":", F.lit(name), s["start"], s["end"]))

    def written(kinds) -> Column:
        return F.concat_ws(",", *[of_kind(kind.name) for kind in kinds])

    base = [k for k in KINDS if not k.added]
    # The spans pass a generator of one element, so that no pattern is matched again for each use.
    held = found.select("doc_id", F.explode(F.array(F.struct(*[F.col(k.name) for k in KINDS]))).alias("s")) \
        .select("doc_id", "s.*")
    return held.select(
        "doc_id", *[F.size(k.name).cast("long").alias(f"n_{k.name}") for k in base],
        F.sha2(written(base), 256).alias("base_sha256"), written(KINDS).alias("spans"),
        F.array_max(F.concat(*[F.transform(k.name, lambda s: s["score"]) for k in KINDS])).alias("top_score"))
