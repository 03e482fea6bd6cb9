"""Personal data: patterns propose spans, checksums confirm them, context moves the score.

DataFrame functions only. A pattern's matches and the text between them come from the
same leftmost, non-overlapping search, so adding up their lengths gives positions in
code points. Quantifiers are possessive, and a match may not begin inside a run that
was already refused, so long runs neither backtrack nor overflow a stack; the matches
are those of the plain patterns. An IBAN's end shows only in its checksum: its pattern
gives starts, and the ends of words after each are tried.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipyard.functions.columns import bind, fresh, with_once


@dataclass(frozen=True)
class Kind:
    """One kind of data: pattern, check of a match, first score and words that add to it.

    ``hint`` is a cheap pattern that every text with a match has. ``base`` kinds are kept
    whatever the score, the others from ``THRESHOLD`` on.
    """

    name: str
    pattern: str
    hint: str
    score: float
    context: str
    base: bool = True


THRESHOLD = 0.5
CONTEXT_GAIN = 0.35
#: Characters before and after a match in which context words count.
BEFORE, AFTER = 40, 20

#: In the order in which spans are listed.
KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@", 0.9, "e-?mail|mail|contact|write",
    ),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.6, "ip|address|host|server"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]", 0.8, "card|visa|credit|debit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.6, "phone|call|tel|mobile|fax"),
    Kind(
        # An empty match at every place where one may begin; the group is all that may belong to it.
        "iban", r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+[A-Za-z0-9]?))", r"[A-Z]{2}[0-9]{2}",
        0.95, "iban|account|bank|konto", False,
    ),
    Kind(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]-[0-9]",
        0.3, "ssn|social|security|taxpayer", False,
    ),
    Kind(
        "secret", r"(?<![A-Za-z0-9])[0-9a-f]{32,64}+(?![A-Za-z0-9])", r"[0-9a-f]{32}",
        0.3, "token|secret|password|key|api", False,
    ),
)

_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_IP = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"
_BLOCK = 64
#: Registered lengths of IBANs by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Does a string of digits pass the Luhn check?"""

    def step(total, i):
        digit = F.substring(digits, -i, 1).cast("int")
        return total + F.when(i % 2 == 1, digit).otherwise(digit * 2 - F.when(digit > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def mod97(iban: Column) -> Column:
    """Does an IBAN without spaces leave 1 modulo 97?"""

    def step(rest, char):
        value = F.when(char.between("0", "9"), F.ascii(char) - 48).otherwise(F.ascii(char) - 55)
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    turned = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))
    return F.aggregate(F.split(turned, "(?!^)(?!$)"), F.lit(0), step) == 1


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(_IP)
    if kind == "card":
        return bind(_digits(value), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    if kind == "ssn":
        return ~value.rlike(r"^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _running_starts(sizes: Column) -> Column:
    """Sum of the array elements before each element; blocks keep it near linear."""
    zero = F.lit(0)

    def total(part):
        return F.aggregate(part, zero, lambda a, x: a + x)

    def blocks(s):
        numbers = F.sequence(zero, F.floor((F.size(s) - 1) / _BLOCK).cast("int"))
        sums = F.transform(numbers, lambda b: total(F.slice(s, b * _BLOCK + 1, _BLOCK)))

        def of_block(t):
            def within(b):
                own = F.slice(s, b * _BLOCK + 1, _BLOCK)
                begin = total(F.slice(t, F.lit(1), b))
                return F.transform(own, lambda _, i: begin + total(F.slice(own, F.lit(1), i)))

            return F.flatten(F.transform(numbers, within))

        return bind(sums, of_block)

    return F.when(F.size(sizes) > 0, bind(sizes, blocks)).otherwise(F.array().cast("array<int>"))


_SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def kind_spans(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind as ``array<struct<kind, start, end, score>>``."""

    def build(found):
        gaps, values = found["gaps"], found["values"]
        sizes = F.zip_with(F.slice(gaps, F.lit(1), F.size(values)), values, lambda g, v: F.length(g) + F.length(v))

        def with_starts(starts):
            def span(value, i):
                near = F.lower(
                    F.concat_ws(" ", F.right(F.get(gaps, i), F.lit(BEFORE)), F.left(F.get(gaps, i + 1), F.lit(AFTER)))
                )
                start = F.get(starts, i) + F.length(F.get(gaps, i))
                gain = F.when(near.rlike(f"(?<![a-z0-9])(?:{kind.context})(?![a-z0-9])"), CONTEXT_GAIN).otherwise(0.0)
                return F.struct(
                    F.lit(kind.name).alias("kind"),
                    start.alias("start"),
                    (start + F.length(value)).alias("end"),
                    F.least(F.lit(1.0), F.lit(kind.score) + gain).alias("score"),
                    _passes(kind.name, value).alias("ok"),
                )

            return F.transform(values, span)

        spans = bind(_running_starts(sizes), with_starts)
        kept = F.filter(spans, lambda s: s["ok"] & (F.lit(kind.base) | (s["score"] >= THRESHOLD)))
        return F.transform(kept, lambda s: F.struct(s["kind"], s["start"], s["end"], s["score"]))

    found = F.struct(
        F.split(text, kind.pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("values"),
    )
    return F.when(text.rlike(kind.hint), bind(found, build)).otherwise(F.array()).cast(_SPAN)


def iban_length(run: Column) -> Column:
    """Characters of the IBAN at the start of ``run``, spaces included; 0 if there is none.

    It ends where a word ends, has 15 to 34 letters and digits and passes mod-97. Of
    several such ends that of the country's registered length counts, else the last.
    """
    code = F.left(run, F.lit(2))
    registered = F.lit(0)
    for n, codes in IBAN_LENGTHS.items():
        registered = F.when(code.isin(codes.split()), n).otherwise(registered)

    def measure(words):
        # The last word runs on if it ends in a small letter.
        ends = F.sequence(F.lit(1), F.size(words))
        whole = F.filter(ends, lambda k: (k < F.size(words)) | ~F.get(words, k - 1).rlike("[a-z]$"))

        def end(k):
            return bind(
                F.array_join(F.slice(words, F.lit(1), k), ""),
                lambda v: F.when(
                    F.length(v).between(15, 34) & mod97(v),
                    F.struct((F.length(v) == registered).alias("known"), (F.length(v) + k - 1).alias("n")),
                ),
            )

        return F.coalesce(F.array_max(F.transform(whole, end))["n"], F.lit(0))

    return bind(F.split(run, " "), measure)


def iban_spans(text: Column, kind: Kind) -> Column:
    """Confirmed spans of IBANs: every start is tried, the first of overlapping ones counts."""

    def build(found):
        # No empty piece comes before a match at the very start.
        gaps = F.when(F.size(found["gaps"]) > F.size(found["runs"]), F.slice(found["gaps"], F.lit(1), F.size(found["runs"])))
        gaps = F.coalesce(gaps, F.concat(F.array(F.lit("")), F.slice(found["gaps"], F.lit(1), F.size(found["runs"]) - 1)))
        sizes = F.transform(gaps, lambda g: F.length(g))

        def place(sizes):
            def with_starts(before):
                def candidate(run, i):
                    start = F.get(before, i) + F.get(sizes, i)
                    return bind(iban_length(run), lambda n: F.struct(start.alias("start"), (start + n).alias("end")))

                passed = F.filter(F.transform(found["runs"], candidate), lambda s: s["end"] > s["start"])
                none = F.array().cast("array<struct<start:int,end:int>>")
                return F.aggregate(
                    passed, none,
                    lambda a, s: F.when(s["start"] >= F.coalesce(F.get(a, F.size(a) - 1)["end"], F.lit(0)), F.concat(a, F.array(s))).otherwise(a),
                )

            return bind(_running_starts(sizes), with_starts)

        def scored(spans):
            def span(s, i):
                left = F.greatest(s["start"] - BEFORE, F.coalesce(F.when(i > 0, F.get(spans, F.greatest(i - 1, F.lit(0)))["end"]), F.lit(0)))
                right = F.least(s["end"] + AFTER, F.coalesce(F.get(spans, i + 1)["start"], s["end"] + AFTER))
                near = F.lower(
                    F.concat_ws(" ", F.substr(text, left + 1, s["start"] - left), F.substr(text, s["end"] + 1, right - s["end"]))
                )
                gain = F.when(near.rlike(f"(?<![a-z0-9])(?:{kind.context})(?![a-z0-9])"), CONTEXT_GAIN).otherwise(0.0)
                return F.struct(F.lit(kind.name).alias("kind"), s["start"], s["end"], F.least(F.lit(1.0), F.lit(kind.score) + gain).alias("score"))

            return F.transform(spans, span)

        return bind(bind(sizes, place), scored)

    found = F.struct(
        F.split(text, kind.pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(1)).alias("runs"),
    )
    return F.when(text.rlike(kind.hint), bind(found, build)).otherwise(F.array()).cast(_SPAN)


def find_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``spans``: all spans by kind as listed in ``KINDS``, then by start.

    ``start`` and ``end`` count code points, ``end`` is exclusive. Spans of different
    kinds may overlap. A null text has none. A column named ``spans`` is replaced.
    Nothing is shuffled and each text is read whole.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    spans = F.concat(*[(iban_spans if kind.name == "iban" else kind_spans)(text, kind) for kind in KINDS])
    return with_once(docs.drop("spans"), spans=spans)


def span_list(spans: Column, base_only: bool = False) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    if base_only:
        names = [k.name for k in KINDS if k.base]
        spans = F.filter(spans, lambda s: s["kind"].isin(names))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def mask_pii(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets.

    Overlapping spans are hidden by one mark, that of the first. A null text stays null.
    """
    text, spans = F.col(text_col), F.col(spans_col)

    def rebuild(sorted_spans):
        def piece(span, i):
            # The end of all that was hidden before; a text has few spans.
            done = F.aggregate(F.slice(sorted_spans, F.lit(1), i), F.lit(0), lambda a, s: F.greatest(a, s["end"]))
            return bind(
                done,
                lambda d: F.when(
                    span["start"] >= d,
                    F.concat(F.substr(text, d + 1, span["start"] - d), F.lit("["), F.upper(span["kind"]), F.lit("]")),
                ).otherwise(F.lit("")),
            )

        last = F.array_max(F.transform(sorted_spans, lambda s: s["end"]))
        return F.concat(F.array_join(F.transform(sorted_spans, piece), ""), F.substr(text, last + 1, F.length(text)))

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    masked = F.when(text.isNull() | (F.size(spans) == 0), text).otherwise(bind(ordered, rebuild))
    columns = [F.col(c) for c in docs.columns if c != text_col]
    name = fresh(docs.columns, "_masked")  # no clash with any column of ``docs``
    return with_once(docs, **{name: masked}).select(*columns, F.col(name).alias(text_col))
