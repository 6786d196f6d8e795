"""Format-preserving pseudonyms for personal numbers and dates.

Every valid number or date found in a text is replaced by another valid one of the same format,
chosen by a keyed permutation (a Feistel network), so equal values become equal pseudonyms in all
documents, different values stay different, and the holder of the key can turn them back:

* payment cards (13 to 19 digits, optionally in groups, Luhn-valid): the digits between the first
  and the check digit are permuted, and the check digit is set anew;
* North American phone numbers: the first digits of area code and exchange stay within 2 to 9; where
  +1 or parentheses mark a number as one, they may be 0 or 1 and stay within those;
* IPv4 addresses: the 32 bits are permuted;
* calendar dates (yyyy-mm-dd, yyyy/mm/dd, dd.mm.yyyy): days of 1950 to 2049 are permuted among
  themselves, and those of the rest of 1800 to 2199 likewise;
* e-mail addresses: letters and digits of the local part are permuted within their kind.

What does not validate (a failed check digit, 31 February, octet 256, a year outside 1800 to 2199)
is left as it is and not counted.  A round adds a keyed hash (SHA-256) of one half to the other half;
``ROUNDS`` rounds; a long half draws a keyed stream from one hash, so the work is linear in its
length.  No pattern repeats a group without a bound, so long texts cannot exhaust the stack.
Everything is a built-in expression within the row: no shuffle, whatever the skew.

Null text stays null, with counts of 0.  Extra columns pass through; the count columns replace
columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.llm.common import free_name, let
from ratebook.sources.tables import table

ROUNDS = 8
KEY = "public demonstration key"            # a deployment passes its own secret

# The formats, by kind, in the order in which they are tried.
_EDGE, _END = r"(?<![0-9A-Za-z_])", r"(?![0-9A-Za-z_])"
FORMATS = {
    "email": r"(?<![0-9A-Za-z._%+-])[A-Za-z0-9._%+-]++@(?!\.)[A-Za-z0-9.-]*\.[A-Za-z]{2,}",
    "date": rf"{_EDGE}(?:[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}|[0-9]{{2}}\.[0-9]{{2}}\.[0-9]{{4}}){_END}",
    "ip": rf"{_EDGE}(?<![0-9]\.)[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}(?!\.?[0-9A-Za-z_])",
    "phone": r"(?<![0-9A-Za-z_+])(?:(?:(?:\+1[ .-]?)?\([0-9]{3}\) ?|\+1[ .-]?[0-9]{3}[ .-])[0-9]{3}|[2-9][0-9]{2}[ .-][2-9][0-9]{2})[ .-][0-9]{4}(?![0-9A-Za-z_])",
    "card": rf"{_EDGE}[0-9](?:[ -]?[0-9]){{12,18}}{_END}",
}
PATTERN = "|".join(FORMATS.values())
# Days since 1970-01-01 of 1800-01-01, 1950-01-01, 2050-01-01 and 2200-01-01, and sizes that
# factor the two ranges exactly: 36525 = 75 * 487 days inside, 109572 = 276 * 397 days outside.
D1800, D1950, D2050, D2200 = -62091, -7305, 29220, 84006
INSIDE, OUTSIDE = (75, 487), (276, 397)


def _draw(key: str, *parts: Column) -> Column:
    """28 keyed pseudo-random bits of the parts."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256), 1, 7), 16, 10).cast("bigint")


def _rounds(back: bool) -> Column:
    order = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    return F.array(*[F.lit(r) for r in order])


def permute_number(x: Column, a: int, b: int, key: str, back: bool = False) -> Column:
    """A keyed permutation of 0 .. a * b - 1: halves (x div b, x mod b), changed in turn."""
    sign = -1 if back else 1

    def step(s: Column, r: Column) -> Column:
        even = r % 2 == 0
        left = F.pmod(s["l"] + sign * _draw(key, F.lit(f"{a}*{b}"), r, s["r"]), F.lit(a).cast("bigint"))
        right = F.pmod(s["r"] + sign * _draw(key, F.lit(f"{a}*{b}"), r, s["l"]), F.lit(b).cast("bigint"))
        return F.struct(F.when(even, left).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(right).alias("r"))

    start = F.struct(F.floor(x / F.lit(b)).cast("bigint").alias("l"), F.pmod(x, F.lit(b)).cast("bigint").alias("r"))
    return F.aggregate(_rounds(back), start, step, lambda s: s["l"] * F.lit(b) + s["r"])


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _hex(digest: Column) -> Column:
    return F.conv(digest, 16, 10).cast("bigint")


# The first character and the number of characters of each kind of a mask.
KINDS = {"d": (48, 10), "n": (50, 8), "b": (48, 2), "a": (97, 26), "A": (65, 26)}


def permute_text(text: Column, mask: Column, key: str, back: bool = False) -> Column:
    """A keyed permutation of strings of one mask: each character stays in its kind (d: 0-9, n: 2-9,
    b: 0-1, a: a-z, A: A-Z)."""
    return F.array_join(permute_chars(text, mask, key, back), "")


def permute_chars(text: Column, mask: Column, key: str, back: bool = False) -> Column:
    """``permute_text`` as an array of characters."""
    sign = -1 if back else 1

    def added(half: Column, sizes: Column, other: Column, r: Column, mask: Column) -> Column:
        # one hash of the other half seeds a stream: 16 characters take a block of 64 hexadecimal digits
        seed = F.sha2(F.concat_ws("|", F.lit(key), mask, r.cast("string"), F.array_join(other.cast("array<string>"), ",")), 256)

        def filled(seed: Column) -> Column:
            blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(half) / 16).cast("int")),
                                 lambda b: F.sha2(F.concat_ws("|", seed, b.cast("string")), 256))
            return let(blocks, lambda bs: F.transform(half, lambda x, i: F.pmod(
                x + sign * _hex(F.substring(F.get(bs, F.floor(i / 16).cast("int")), F.pmod(i, F.lit(16)) * 4 + 1, F.lit(4))),
                F.get(sizes, i))))

        return let(seed, filled)

    def run(s: Column) -> Column:
        n = F.size(s["x"])
        cut = F.floor((n + 1) / 2).cast("int")

        def halves(a: Column) -> tuple[Column, Column]:
            return F.slice(a, F.lit(1), cut), F.slice(a, cut + 1, n - cut)

        def step(h: Column, r: Column) -> Column:
            even = r % 2 == 0
            return F.struct(F.when(even, added(h["l"], h["sl"], h["r"], r, s["mask"])).otherwise(h["l"]).alias("l"),
                            F.when(even, h["r"]).otherwise(added(h["r"], h["sr"], h["l"], r, s["mask"])).alias("r"),
                            h["sl"].alias("sl"), h["sr"].alias("sr"))

        (left, right), (sl, sr) = halves(s["x"]), halves(s["size"])
        start = F.struct(left.alias("l"), right.alias("r"), sl.alias("sl"), sr.alias("sr"))
        done = F.aggregate(_rounds(back), start, step, lambda h: F.concat(h["l"], h["r"]))
        return let(done, lambda d: F.transform(d, lambda x, i: F.char(x + F.get(s["base"], i))))

    base = F.create_map(*[F.lit(x) for k, (first, _) in KINDS.items() for x in (k, first)])
    size = F.create_map(*[F.lit(x) for k, (_, count) in KINDS.items() for x in (k, count)])
    return let(F.struct(text.alias("t"), mask.alias("m")), lambda p: let(
        F.struct(F.transform(_chars(p["m"]), lambda k: base[k]).alias("base"), F.transform(_chars(p["m"]), lambda k: size[k].cast("bigint")).alias("size"),
                 _chars(p["t"]).alias("c"), p["m"].alias("mask")),
        lambda q: let(F.struct(F.transform(q["c"], lambda c, i: (F.ascii(c) - F.get(q["base"], i)).cast("bigint")).alias("x"),
                               q["base"].alias("base"), q["size"].alias("size"), q["mask"].alias("mask")), run)))


def _refilled(shape: Column, kept: str, values: Column) -> Column:
    """``shape`` with its characters of class ``kept`` replaced, in order, by the array ``values``."""
    between = F.split(shape, f"[{kept}]", -1)
    return let(values, lambda v: F.array_join(F.transform(between, lambda s, i: F.concat(s, F.coalesce(F.get(v, i), F.lit("")))), ""))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string."""
    n = F.length(digits)

    def add(a: Column, i: Column) -> Column:
        d = F.substring(digits, i + 1, F.lit(1)).cast("int")
        twice = (n - i) % 2 == 0
        return a + F.when(twice, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def _card(m: Column, key: str, back: bool) -> Column:
    def new(d: Column) -> Column:
        middle = F.substring(d, F.lit(2), F.length(d) - 2)
        inner = permute_text(middle, F.repeat(F.lit("d"), F.length(middle)), key, back)
        return let(F.concat(F.substring(d, 1, 1), inner), lambda b: _chars(
            F.concat(b, F.pmod(F.lit(10) - _luhn(F.concat(b, F.lit("0"))) % 10, F.lit(10)).cast("string"))))
    return let(_digits(m), lambda d: F.when(_luhn(d) % 10 == 0, _refilled(m, "0-9", let(d, new))))


def _phone(m: Column, key: str, back: bool) -> Column:
    def lead(d: Column, at: int) -> Column:
        return F.when(F.substring(d, at, 1) < "2", "b").otherwise("n")

    def new(d: Column) -> Column:                # the last ten digits; a leading country code stays
        ten = let(F.substring(d, -10, 10), lambda x: permute_chars(
            x, F.concat(lead(x, 1), F.lit("dd"), lead(x, 4), F.lit("dddddd")), key, back))
        return F.concat(_chars(F.substring(d, F.lit(1), F.length(d) - 10)), ten)
    return _refilled(m, "0-9", let(_digits(m), new))


def _ip(m: Column, key: str, back: bool) -> Column:
    def new(o: Column) -> Column:
        value = ((o[0] * 256 + o[1]) * 256 + o[2]) * 256 + o[3]
        return let(permute_number(value, 65536, 65536, key, back), lambda v: F.concat_ws(".", *[
            F.pmod(F.floor(v / F.lit(256 ** k)), F.lit(256)).cast("bigint").cast("string") for k in (3, 2, 1, 0)]))
    octets = F.split(m, r"\.").cast("array<bigint>")
    # an octet with a leading zero is not canonical and would not come back the same
    valid = ~m.rlike(r"(^|\.)0[0-9]") & F.forall(octets, lambda o: o <= 255)
    return F.when(valid, let(octets, new))


def _date(m: Column, key: str, back: bool) -> Column:
    day_first = m.rlike(r"^[0-9]{2}\.")
    iso = F.when(day_first, F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2))) \
        .otherwise(F.replace(m, F.lit("/"), F.lit("-")))

    def new(d: Column) -> Column:
        inside = D1950 + permute_number(d - D1950, *INSIDE, key, back)
        size = D2050 - D1950
        out = permute_number(F.when(d < D1950, d - D1800).otherwise(d - D1800 - size), *OUTSIDE, key, back)
        outside = F.when(out < D1950 - D1800, out + D1800).otherwise(out + D1800 + size)
        return F.when((d >= D1950) & (d < D2050), inside).when((d >= D1800) & (d < D2200), outside).otherwise(d)

    day = F.unix_date(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date")).cast("bigint")

    def text(d: Column) -> Column:
        date = F.date_from_unix_date(d.cast("int"))
        return F.when(day_first, F.date_format(date, "dd.MM.yyyy")).when(m.contains("/"), F.date_format(date, "yyyy/MM/dd")) \
            .otherwise(F.date_format(date, "yyyy-MM-dd"))

    return let(day, lambda d: F.when((d >= D1800) & (d < D2200), let(new(d), text)))


def _email(m: Column, key: str, back: bool) -> Column:
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    varied = F.regexp_replace(local, "[^0-9A-Za-z]", "")
    mask = F.regexp_replace(F.regexp_replace(F.regexp_replace(varied, "[A-Z]", "\u0001"), "[a-z]", "a"), "[0-9]", "d")
    mask = F.replace(mask, F.lit("\u0001"), F.lit("A"))
    # labels are not empty: what follows two dots is not part of the domain
    valid = F.substring_index(domain, "..", 1).rlike(r"\.[A-Za-z]{2}")
    return F.when(valid & (F.length(varied) > 0), F.concat(_refilled(local, "0-9A-Za-z", let(F.struct(varied.alias("v"), mask.alias("m")),
                                                 lambda s: permute_chars(s["v"], s["m"], key, back))), F.lit("@"), domain))


_KINDS = {"email": _email, "date": _date, "ip": _ip, "phone": _phone, "card": _card}


def pseudonym(match: Column, key: str = KEY, back: bool = False) -> Column:
    """(kind, value) of a matched text: its pseudonym, or kind null and the text itself if it is not valid."""
    def tried(kind: str, otherwise: Column) -> Column:
        named = let(let(match, lambda m: _KINDS[kind](m, key, back)), lambda v: F.struct(
            F.when(v.isNotNull(), F.lit(kind)).alias("kind"), F.coalesce(v, match).alias("value")))
        return F.when(match.rlike(f"^(?:{FORMATS[kind]})$"), named).otherwise(otherwise)

    found = F.struct(F.lit(None).cast("string").alias("kind"), match.alias("value"))
    for kind in reversed(list(FORMATS)):
        found = tried(kind, found)
    return found


def pseudonymize(docs: DataFrame, text: str = "text", key: str = KEY, back: bool = False) -> DataFrame:
    """``docs`` with ``text`` rewritten and a count ``n_<kind>`` (long) of what was replaced.  ``back``
    turns pseudonyms into the values they stand for (same key)."""
    t = F.col(text)
    matches = F.transform(F.regexp_extract_all(t, F.lit(f"({PATTERN})"), 1), lambda m: pseudonym(m, key, back))
    # few texts hold any candidate; only those are cut up
    some = t.rlike("[0-9@]")
    pii = free_name(docs, "_pii")
    found = docs.withColumn(pii, F.when(some, matches))
    parts = F.split(t, PATTERN, -1)
    whole = F.array_join(F.transform(parts, lambda p, i: F.concat(p, F.coalesce(F.get(F.col(pii), i)["value"], F.lit("")))), "")

    def counted(kind: str) -> Column:
        return F.coalesce(F.size(F.filter(pii, lambda m: F.coalesce(m["kind"] == kind, F.lit(False)))), F.lit(0)).cast("bigint")

    counts = {f"n_{k}": counted(k) for k in FORMATS}
    return found.withColumns({**counts, text: F.when(F.size(pii) > 0, whole).otherwise(t)}).drop(pii)


def op2_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymize(table(spark, sf_dir, "documents", "doc_id", "text"))
