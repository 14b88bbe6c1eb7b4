"""Personal data, found with DataFrame functions only.

Regular expressions propose spans; validators confirm them (parts of an
address at most 255, Luhn for cards, mod 97 for bank accounts, digit counts for
phones); context words near a span raise or lower its score. Confirmed spans of
the four base kinds always stay; the other kinds are kept from ``min_score``.

The patterns repeat possessively over single characters or flat groups, so a
match of any length is found without recursion, and an address or number
starts where its run of characters starts (or where the last match ended), so a
long run is read once.

Positions count code points. ``split`` by a pattern gives the gaps between its
leftmost non-overlapping matches, and the running sum of gap and match lengths
gives each match's start; that sum is a window over the matches of one document
and kind, so a text with very many matches is a sorted run, not one array.

Null and empty texts have no spans; texts of any length are searched whole. Where
two kinds match the same characters (a tie) both spans are given. Repeated rows are searched each on their
own. An empty table gives an empty result; columns other than id and text are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CONTEXT = 40    # characters of context on each side


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    guard: str              # a cheap pattern that every text with a match has
    valid: str              # name of the validator
    score: float            # of a validated span without context
    up: str = ""            # context words, as a pattern
    down: str = ""
    base: bool = False


KINDS = [
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", "any", 0.9,
         r"\b(e-?mail|contact|write|mailto)\b", "", True),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]+\.[0-9]", "octets", 0.6,
         r"\b(ip|address|host|server|addr)\b", r"\b(version|release|build|v)\b", True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){12}", "luhn", 0.8,
         r"\b(card|visa|credit|debit|mastercard|payment)\b", r"\b(order|serial|isbn|tracking)\b", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", "phone", 0.6,
         r"\b(phone|tel|call|fax|mobile|whatsapp)\b", "", True),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}", "mod97", 0.9, r"\b(iban|account|konto|bank)\b"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "ssn", 0.4,
         r"\b(ssn|social security|social)\b", ""),
    Kind("access_key", r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])", "AKIA", "any", 0.9),
    Kind("secret", r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{24,128}+(?![A-Za-z0-9_-])", r"[A-Za-z0-9_-]{24}", "mixed", 0.4,
         r"\b(token|secret|passw(or)?d|api[_-]?key|key|credentials?|bearer|auth)\b"),
]
BASE = [k.name for k in KINDS if k.base]


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True when the digit string passes Luhn."""
    n = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0),
        lambda s, i: s + _luhn_digit(F.substring(digits, i, F.lit(1)).cast("int"), (n - i) % 2 == 1))
    return F.coalesce(total % 10 == 0, F.lit(False))


def _luhn_digit(d: Column, double: Column) -> Column:
    return F.when(double, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)


def mod97(account: Column) -> Column:
    """True when an account number, its first four characters moved to the end
    and letters read as 10 to 35, leaves 1 modulo 97."""
    a = F.regexp_replace(account, "[^0-9A-Z]", "")
    a = F.concat(F.substring(a, F.lit(5), F.length(a)), F.substring(a, 1, 4))

    def step(s, i):
        code = F.ascii(F.substring(a, i, F.lit(1)))
        return F.when(code < 58, (s * 10 + code - 48) % 97).otherwise((s * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(a), F.lit(1))), F.lit(0), step) == 1


def _valid(kind: str, m: Column) -> Column:
    d = _digits(m)
    if kind == "octets":
        def large(p):
            p = F.regexp_replace(p, "^0+", "")
            return (F.length(p) > 3) | (F.coalesce(F.substring(p, 1, 3).try_cast("int"), F.lit(0)) > 255)
        return ~F.exists(F.split(m, r"\."), large)
    if kind == "luhn":
        return F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(d).between(9, 15)
    if kind == "mod97":
        return F.when(F.length(F.regexp_replace(m, " ", "")).between(15, 34), mod97(m)).otherwise(False)
    if kind == "mixed":
        return (d != "") & m.rlike("[A-Za-z]")
    if kind == "ssn":
        return ~d.rlike("^(000|666|9)") & ~d.rlike("^...00") & ~d.rlike("0000$")
    return F.lit(True)


def _match_row(i: int):
    def row(z, j):
        near = F.concat(F.substring(z["a"], F.lit(-CONTEXT), F.lit(CONTEXT)), F.lit(" "),
                        F.substring(z["b"], 1, CONTEXT))
        return F.struct(F.lit(i).alias("kind"), j.alias("k"), F.length(z["a"]).alias("gap"), z["m"].alias("m"),
                        F.lower(near).alias("near"))
    return row


def find(docs: DataFrame, id_col: str = "doc_id", text: str = "text", kinds: list[Kind] = KINDS,
         min_score: float = 0.6) -> DataFrame:
    """Spans of every document, one row per span, and one row without a span
    for each document that has none: ``row, id, kind, start, end, value,
    score``. ``row`` tells repeated ids apart."""
    d = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text).alias("t"))
    for k in kinds:
        found = F.contains("t", F.lit(k.guard)) if k.guard.isalnum() or k.guard == "@" else F.col("t").rlike(k.guard)
        d = d.withColumn(f"m_{k.name}", F.when(found, F.regexp_extract_all("t", F.lit(k.pattern), F.lit(0))))
    for k in kinds:
        d = d.withColumn(f"g_{k.name}", F.when(F.size(f"m_{k.name}") > 0, F.split("t", k.pattern, -1)))
    lists = []
    for i, k in enumerate(kinds):
        m, g = F.col(f"m_{k.name}"), F.col(f"g_{k.name}")
        n = F.size(m)
        zipped = F.arrays_zip(m.alias("m"), F.slice(g, F.lit(1), n).alias("a"), F.slice(g, F.lit(2), n).alias("b"))
        lists.append(F.when(n > 0, F.transform(zipped, _match_row(i))))
    none = F.array().cast("array<struct<kind:int,k:int,gap:int,m:string,near:string>>")
    d = d.select("row", "id", F.concat(*[F.coalesce(x, none) for x in lists]).alias("all"))
    d = d.select("row", "id", F.explode_outer("all").alias("x")).select("row", "id", "x.*")
    d = d.repartition("row")
    w = W.partitionBy("row", "kind").orderBy("k").rowsBetween(W.unboundedPreceding, W.currentRow)
    d = d.withColumn("end", F.sum(F.col("gap").cast("long") + F.length("m")).over(w))
    d = d.withColumn("start", F.col("end") - F.length("m"))
    ok, score, base = F.lit(None).cast("boolean"), F.lit(None).cast("double"), F.lit(False)
    for i, k in reversed(list(enumerate(kinds))):
        here = F.col("kind") == i
        ok = F.when(here, _valid(k.valid, F.col("m"))).otherwise(ok)
        s = F.lit(k.score)
        if k.up:
            s = s + F.when(F.col("near").rlike(k.up), 0.2).otherwise(0.0)
        if k.down:
            s = s - F.when(F.col("near").rlike(k.down), 0.2).otherwise(0.0)
        score = F.when(here, F.least(F.lit(1.0), s)).otherwise(score)
        base = F.when(here, F.lit(k.base)).otherwise(base)
    d = d.withColumn("score", score).withColumn("keep", ok & (base | (F.col("score") >= min_score)))
    shown = F.when(F.col("keep"), F.element_at(F.array(*[F.lit(k.name) for k in kinds]), F.col("kind") + 1))
    return d.select("row", "id", F.when(F.col("keep"), F.col("kind")).alias("order"), shown.alias("kind"),
                    *[F.when(F.col("keep"), F.col(c)).alias(c) for c in ("start", "end")],
                    F.when(F.col("keep"), F.col("m")).alias("value"),
                    F.when(F.col("keep"), F.col("score")).alias("score"))


def report(spans: DataFrame, kinds: list[Kind] = KINDS) -> DataFrame:
    """One row per document: counts of the base kinds, the digest of the base
    spans and all spans as text."""
    mark = F.concat_ws(":", "kind", "start", "end")
    all_spans = F.sort_array(F.collect_list(F.when(F.col("kind").isNotNull(), F.struct(
        "order", "start", F.col("kind").isin(*[k.name for k in kinds if k.base]).alias("base"), mark.alias("s")))))
    g = spans.groupBy("row").agg(
        F.first("id").alias("id"), *[F.count(F.when(F.col("kind") == k.name, 1)).alias(f"n_{k.name}")
                                     for k in kinds if k.base], all_spans.alias("x"))
    return g.select("id", *[f"n_{k.name}" for k in kinds if k.base],
                    F.sha2(F.concat_ws(",", F.transform(F.filter("x", lambda z: z["base"]), lambda z: z["s"])), 256)
                    .alias("base_sha256"),
                    F.concat_ws(",", F.transform("x", lambda z: z["s"])).alias("spans"))


def redact(docs: DataFrame, text: str = "text", kinds: list[Kind] = KINDS) -> DataFrame:
    """The documents with the proposals of the base kinds replaced by their
    kind's name in brackets (a wide mask: proposals are not validated)."""
    out = F.col(text)
    for k in kinds:
        if k.base:
            out = F.regexp_replace(out, k.pattern, f"[{k.name}]")
    return docs.withColumn(text, out)
