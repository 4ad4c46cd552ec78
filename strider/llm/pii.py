"""Personal data: patterns propose spans, checks confirm them, and context words nearby move the score.

Native: DataFrame functions only. A pattern's matches and the text between them (split and regexp_extract_all see the
same leftmost matches) give positions by running sums, so nothing is searched twice. Kinds of the base contract are kept
wherever their own check passes (score 1 before context); kinds that the method adds need `threshold`, which a checksum
(mod 97 for IBANs), or a pattern with a context word within `window` code points, reaches.

Defined results: null or empty text has no span; positions are code points, the end exclusive; spans sort by start, then
by kind in the order of KINDS; repeated rows are scanned each; very long digit or address runs are matched in linear time,
since a failed run is not entered again in its middle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The patterns of the base contract, in its order.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


@dataclass(frozen=True)
class Kind:
    """base: part of the contract. match: the pattern, written so that a run is entered at its first character only
    (or where the last match ended), which changes no match. gate: a cheap pattern without which there is no match.
    score: of a confirmed match without context; context: words that add 0.4 when one is nearby."""

    name: str
    match: str
    gate: str
    score: float
    context: tuple[str, ...]
    base: bool = True


KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, ("mail", "email", "contact", "write")),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.6, ("ip", "host", "server", "address")),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", 0.8, ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.7, ("phone", "tel", "call", "mobile", "fax", "telefon")),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "", 0.8, ("iban", "account", "bank", "konto", "compte", "cuenta"), False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.3, ("ssn", "social", "security", "tax"), False),
    Kind("national_phone", r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])", "", 0.3, ("phone", "tel", "call", "mobile", "fax", "telefon"), False),
)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    d = F.split(F.reverse(digits), "")
    total = F.aggregate(
        F.transform(d, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int"))),
        F.lit(0),
        lambda a, x: a + x,
    )
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN (blanks removed) leaves 1 modulo 97."""
    moved = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))
    value = F.aggregate(
        F.split(moved, ""),
        F.lit(0),
        lambda a, c: F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
    )
    return value == 1


def confirmed(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 2) | ((F.length(F.ltrim(p, F.lit("0"))) == 3) & (F.ltrim(p, F.lit("0")) <= "255")))
    if kind == "card":
        return F.length(digits).between(14, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        bare = F.replace(m, F.lit(" "), F.lit(""))
        return F.length(bare).between(15, 34) & mod97(bare)
    if kind == "ssn":
        return ~m.startswith("000") & ~m.startswith("666") & (F.substring(m, 5, 2) != "00") & (F.substring(m, 8, 4) != "0000")
    return F.lit(True)


SPAN = "array<struct<start:int,rank:int,kind:string,end:int,score:double>>"


def spans_of(text: Column, rank: int, kind: Kind, window: int, threshold: float) -> Column:
    """The spans of one kind, by start."""
    found = F.regexp_extract_all(text, F.lit(kind.match), F.lit(0))
    lengths = F.transform(F.split(text, kind.match, -1), F.length)
    joined = F.arrays_zip(found.alias("m"), lengths.alias("gap"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["m"])
        span = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("m"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int,m:string>>)").alias("out"))
    placed = F.aggregate(F.filter(joined, lambda x: x["m"].isNotNull()), zero, step)["out"]
    near = "(?i)(?<![a-z])(?:" + "|".join(kind.context) + ")(?![a-z])"

    def scored(x: Column) -> Column:
        from_ = F.greatest(F.lit(1), x["start"] + 1 - window)
        around = F.concat_ws(" ", F.substring(text, from_, x["start"] + 1 - from_), F.substring(text, x["end"] + 1, F.lit(window)))
        return F.least(F.lit(1.0), F.lit(kind.score) + F.when(around.rlike(near), 0.4).otherwise(0.0))

    good = F.filter(placed, lambda x: confirmed(kind.name, x["m"]))
    out = F.transform(
        good, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind.name).alias("kind"), x["end"].alias("end"), scored(x).alias("score"))
    )
    if not kind.base:
        out = F.filter(out, lambda x: x["score"] >= threshold)
    return out


#: Any digit-bearing or address-bearing text goes on; most texts end at these plain searches.
def gate_of(text: Column, kind: Kind) -> Column:
    gate = {
        "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
        "iban": text.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"),
        "ip": text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
        "phone": text.rlike(r"\+[0-9]"),
        "ssn": text.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
        "national_phone": text.rlike(r"[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}"),
    }.get(kind.name)
    return text.contains(kind.gate) if gate is None else gate


def find(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS, window: int = 40, threshold: float = 0.6, out: str = "pii") -> DataFrame:
    """Add `out`: all spans of a text, by start and kind, each with its score."""
    t = F.coalesce(F.col(text), F.lit(""))
    has_digit = t.rlike("[0-9]")
    each = []
    for rank, kind in enumerate(kinds):
        gate = gate_of(t, kind) if kind.name == "email" else has_digit & gate_of(t, kind)
        each.append(F.when(gate, spans_of(t, rank, kind, window, threshold)).otherwise(F.expr(f"cast(array() as {SPAN})")))
    return docs.withColumn(out, F.array_sort(F.concat(*each)))


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", spans: str = "pii") -> DataFrame:
    """Replace every span, overlapping ones together, by its kind in angle brackets; drops the spans."""
    t = F.col(text)

    def step(acc: Column, x: Column) -> Column:
        fresh = x["start"] >= acc["at"]
        piece = F.concat(F.substring(t, acc["at"] + 1, x["start"] - acc["at"]), F.lit("<"), F.upper(x["kind"]), F.lit(">"))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(fresh, F.concat(acc["out"], F.array(piece))).otherwise(acc["out"]).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    done = F.aggregate(F.col(spans), zero, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(t, acc["at"] + 1, F.length(t))))
    return docs.withColumn(text, F.when(F.size(spans) > 0, done).otherwise(t)).drop(spans)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: counts of the base kinds, a hash of the base spans, and all spans; then the spans' scores, in their order."""
    found = find(docs.select("doc_id", "text")).select("doc_id", "pii")
    names = [k.name for k in KINDS if k.base]
    count = lambda n: F.size(F.filter("pii", lambda x: x["kind"] == n)).cast("long")
    return found.select(
        "doc_id",
        *[count(n).alias(f"n_{n}") for n in names],
        F.sha2(listed(F.filter("pii", lambda x: x["kind"].isin(names))).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda x: x["score"].cast("decimal(3,2)").cast("string")), ",").alias("scores"),
    )


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced; n_chars, where there is one, follows the new text."""
    names = docs.columns
    out = redact(find(docs, out="__pii"), spans="__pii")
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*names)
