"""Operator 8 (native): format-preserving Feistel pseudonyms for personal data.

Everything is a Spark SQL expression. One pattern finds the candidates; each is validated by its own rule and
then keyed-permuted inside its format, so that equal values get equal pseudonyms in every document and no two
values share one:

  email   letters and digits before the top-level domain, each kept in its class
  ipv4    four octets of 0..255, as two 16-bit halves
  card    13 to 19 digits with a valid Luhn digit; the check digit is made anew. In a run of groups of digits, numbers
          in the layouts of cards are looked for first, then other formats, and only then is the run one number
  iban    valid modulo 97, unbroken or in groups of four; country and layout stay, check digits are made anew
  phone   ten digits in groups, an international prefix stays
  ssn     nine digits in groups; areas 000, 666, 900-999, group 00 and serial 0000 are no valid numbers
  date    yyyy-mm-dd (a time may follow), dd.mm.yyyy and dd/mm/yyyy of the years 1800 to 2199 (146,097 days, a whole calendar cycle)
  secret  32 to 128 hexadecimal digits of one case

A Feistel network folds rounds over two halves: one half is shifted, symbol by symbol and modulo its alphabet,
by a SHA-256 of key, kind, round and the other half. Undoing the rounds gives the value back (see `invert`).

Defined cases: null text stays null, empty text empty; candidates that fail validation stay as they are; equal
and repeated rows get equal results; an empty table gives an empty table; other columns are kept, but for
those of the output's names; texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import without

#: Rounds of a Feistel network; even, so that halves of unequal length end where they began.
ROUNDS = 8
#: The alphabets that symbols stay in.
DIGITS, LOWER, UPPER, HEX_LOWER, HEX_UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef", "0123456789ABCDEF"
#: Days of a Gregorian cycle, as a product of two factors of like size.
CYCLE_A, CYCLE_B = 189, 773

#: The formats. Possessive quantifiers keep the scan linear.
FORMATS = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9_][\w.%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.[A-Za-z]{2,24}(?![\w-])",
    "iban": r"(?<![\w])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)(?![\w])",
    "secret": r"(?<![\w])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![\w])",
    "date": r"(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([./])[0-9]{2}\1[0-9]{4})(?:(?=T[0-9]{2}:)|(?![\w/-]))(?!\.[0-9])",
    "ipv4": r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w])(?!\.[0-9])",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "phone": r"(?<![\w(+.-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])(?!\.[0-9])",
    "card": r"(?<![\w])(?=[0-9](?:[ -]?[0-9]){12})[0-9]++(?!\w)(?:[ -][0-9]++(?!\w|\.[0-9]))*+",
}
#: Layouts of card numbers in a run of digits, found at every group; and what else a run may hold.
CARD_LAYOUTS = r"(?<![0-9])(?=((?:[0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\3[0-9]{4,5}|[0-9]{13,19})(?![0-9])))"
#: Characters for private use, which no run of digits holds.
OPEN, CLOSE, HYPHEN, MARKS = "\ue000", "\ue001", "\ue002", "\ue010\ue011\ue012\ue013\ue014\ue015\ue016\ue017\ue018\ue019"
IN_RUN = "|".join(FORMATS[k] for k in ("date", "ssn", "phone"))
#: No candidate lacks both of these.
HINT = "[0-9@]"
ANY = "|".join(FORMATS.values())


def _noise(key: str, kind: str, k: Column, half: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{key}|{kind}|"), k.cast("string"), F.lit("|"), half).cast("binary"), 256)


def _alphabet(c: Column, hexadecimal: bool) -> Column:
    """The alphabet a symbol belongs to, empty for separators."""
    if hexadecimal:
        return F.when(c.rlike("[0-9a-f]"), HEX_LOWER).otherwise(HEX_UPPER)
    return F.when(c.between("0", "9"), DIGITS).when(c.rlike("[a-z]"), LOWER).when(c.rlike("[A-Z]"), UPPER).otherwise("")


def _shift(text: Column, noise: Column, sign: int, alphabet) -> Column:
    def one(i: Column) -> Column:
        c = F.substring(text, i, F.lit(1))
        letters = alphabet(c)
        by = F.conv(F.substring(noise, ((i - 1) % 16) * 4 + 1, F.lit(4)), 16, 10).cast("int")
        return F.when(letters == "", c).otherwise(F.substring(letters, F.pmod(F.position(c, letters) - 1 + by * sign, F.length(letters)) + 1, F.lit(1)))

    return F.when(F.length(text) == 0, "").otherwise(F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), one), ""))


def permute_text(text: Column, key: str, kind: str, alphabet, inverse: bool = False) -> Column:
    """Keyed permutation of texts with one layout of alphabets; a text of one symbol or none is shifted by a constant."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    halves = F.struct(F.substring(text, F.lit(1), half).alias("l"), F.substring(text, half + 1, n).alias("r"))
    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    if inverse:
        step = lambda a, k: F.struct(_shift(a["r"], _noise(key, kind, ROUNDS - 1 - k, a["l"]), -1, alphabet).alias("l"), a["l"].alias("r"))
    else:
        step = lambda a, k: F.struct(a["r"].alias("l"), _shift(a["l"], _noise(key, kind, k, a["r"]), 1, alphabet).alias("r"))
    return F.aggregate(rounds, halves, step, lambda a: F.concat(a["l"], a["r"]))


def permute_number(x: Column, y: Column, a: int, b: int, key: str, kind: str, inverse: bool = False) -> Column:
    """Keyed permutation of pairs (x, y) with 0 <= x < a and 0 <= y < b, as a struct of longs."""

    def step(s: Column, k: Column) -> Column:
        k = ROUNDS - 1 - k if inverse else k
        sign = -1 if inverse else 1
        by = lambda half: F.conv(F.substring(_noise(key, kind, k, half.cast("string")), 1, 12), 16, 10).cast("long") * sign
        even = k % 2 == 0
        return F.struct(F.when(even, F.pmod(s["x"] + by(s["y"]), F.lit(a))).otherwise(s["x"]).alias("x"), F.when(even, s["y"]).otherwise(F.pmod(s["y"] + by(s["x"]), F.lit(b))).alias("y"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(x.cast("long").alias("x"), y.cast("long").alias("y")), step)


def _fill(layout: Column, symbols: Column, pattern: str = "[0-9]") -> Column:
    """layout with its symbols, in order, replaced by those given."""
    others = f"[^{pattern[1:]}"

    def one(i: Column) -> Column:
        c = F.substring(layout, i, F.lit(1))
        return F.when(c.rlike(pattern), F.substring(symbols, F.length(F.regexp_replace(F.substring(layout, F.lit(1), i), others, "")), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(layout)), one), "")


def luhn_sum(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def mod97(text: Column) -> Column:
    """Remainder of an IBAN's number: its first four symbols moved to the end, letters as 10 to 35."""
    moved = F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, 1, 4))

    def add(total: Column, i: Column) -> Column:
        c = F.substring(moved, i, F.lit(1))
        v = F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return F.pmod(F.when(v > 9, total * 100 + v).otherwise(total * 10 + v), F.lit(97))

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _part(m: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(m, pattern, group)


def _day(m: Column) -> Column:
    """Days since 1800-01-01 of a date in one of the formats; null if it is none."""
    iso = m.rlike("^[0-9]{4}-")
    read = F.coalesce(
        F.when(iso, F.try_to_timestamp(m, F.lit("yyyy-MM-dd"))),
        F.when(~iso, F.try_to_timestamp(F.regexp_replace(m, "[./]", "-"), F.lit("dd-MM-yyyy"))),
    )
    days = F.datediff(read.cast("date"), F.lit("1800-01-01").cast("date"))
    return F.when((days >= 0) & (days < CYCLE_A * CYCLE_B), days)


def _checked(number: Column, good: Column, value: Column) -> Column:
    return F.when(good, value).otherwise(number)


def _card(m: Column, key: str, inverse: bool) -> Column:
    """The pseudonym of a card number, in its layout; the text itself if it is none."""
    digits = _digits(m)
    body = permute_text(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card", lambda c: _alphabet(c, False), inverse)
    card = F.aggregate(F.array(body), F.lit(""), lambda _, b: F.concat(b, F.pmod(F.lit(0) - luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))
    return _checked(m, F.length(digits).between(13, 19) & (F.pmod(luhn_sum(digits), F.lit(10)) == 0), _fill(m, card))


def _run(m: Column, key: str, inverse: bool) -> Column:
    """A run of groups of digits with the numbers in it replaced: card numbers first, then what else stands beside them."""
    cards = F.transform(F.regexp_extract_all(m, F.lit(CARD_LAYOUTS), 1), lambda v: F.struct(v.alias("v"), _card(v, key, inverse).alias("p")))

    def rest(valid: Column) -> Column:
        """A mark of its own stands for each card meanwhile, with the hyphens at its sides; a run itself holds no marks."""
        marked = F.transform(valid, lambda c, i: F.struct(c["v"].alias("v"), c["p"].alias("p"), F.concat(F.lit(OPEN), F.translate(i.cast("string"), DIGITS, MARKS), F.lit(CLOSE)).alias("mark")))
        # layouts may overlap: the first one wins, as the text of the next is gone then
        text = F.aggregate(marked, m, lambda text, c: F.replace(text, c["v"], c["mark"]))
        text = F.replace(F.replace(text, F.lit(CLOSE + "-"), F.lit(CLOSE + HYPHEN)), F.lit("-" + OPEN), F.lit(HYPHEN + OPEN))
        text = F.replace(_replace(text, IN_RUN, lambda v: pseudonym(v, key, inverse, runs=False)), F.lit(HYPHEN), F.lit("-"))
        return F.aggregate(marked, text, lambda text, c: F.replace(text, c["mark"], c["p"]))

    done = rest(F.filter(cards, lambda c: c["v"] != c["p"]))
    return F.aggregate(F.array(done), F.lit(""), lambda _, x: F.when(x != m, x).otherwise(_card(m, key, inverse)))


def _iban(m: Column, key: str, inverse: bool) -> Column:
    """The pseudonym of an account number, in its layout; of one in groups, the longest valid part from the first group."""
    groups = F.split(m, " ")

    def one(text: Column) -> Column:
        plain = F.replace(text, F.lit(" "), F.lit(""))
        country, account = F.substring(plain, 1, 2), permute_text(F.substring(plain, F.lit(5), F.length(plain)), key, "iban", lambda c: _alphabet(c, False), inverse)
        made = F.aggregate(F.array(account), F.lit(""), lambda _, a: F.concat(country, F.lpad((98 - mod97(F.concat(country, F.lit("00"), a))).cast("string"), 2, "0"), a))
        return _fill(text, made, "[A-Z0-9]")

    starts = F.transform(F.sequence(F.lit(1), F.size(groups)), lambda k: F.array_join(F.slice(groups, F.lit(1), k), " "))
    valid = F.filter(starts, lambda t: (F.length(F.replace(t, F.lit(" "), F.lit(""))) >= 15) & (mod97(F.replace(t, F.lit(" "), F.lit(""))) == 1))
    return F.aggregate(F.slice(F.reverse(valid), 1, 1), m, lambda _, t: F.concat(one(t), F.substring(m, F.length(t) + 1, F.length(m))))


def _replace(text: Column, pattern: str, by) -> Column:
    """text with every match of the pattern replaced."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), by)
    return F.array_join(F.flatten(F.zip_with(F.split(text, pattern, -1), F.concat(found, F.array(F.lit(""))), lambda g, x: F.array(g, x))), "")


def pseudonym(m: Column, key: str, inverse: bool = False, runs: bool = True) -> Column:
    """The pseudonym of a candidate; the candidate itself where validation fails. inverse gives the value back."""
    plain, hexa = (lambda c: _alphabet(c, False)), (lambda c: _alphabet(c, True))
    digits = _digits(m)
    octets = [F.split(m, r"\.")[i].cast("int") for i in range(4)]
    ip = permute_number(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], 65_536, 65_536, key, "ipv4", inverse)
    ip_text = F.aggregate(F.array(ip), F.lit(""), lambda _, v: F.concat_ws(".", F.floor(v["x"] / 256), v["x"] % 256, F.floor(v["y"] / 256), v["y"] % 256))
    prefix, local = _part(m, r"^(\+[0-9]{1,3}[ .-]?)?(.*)$", 1), _part(m, r"^(\+[0-9]{1,3}[ .-]?)?(.*)$", 2)
    phone = F.concat(prefix, _fill(local, permute_text(_digits(local), key, "phone", plain, inverse)))
    area, group, serial = (F.substring(digits, a, n).cast("int") for a, n in ((1, 3), (4, 2), (6, 4)))
    area_at = area - F.when(area > 666, 2).otherwise(1)
    ssn = permute_number(area_at, (group - 1) * 9_999 + serial - 1, 898, 99 * 9_999, key, "ssn", inverse)
    ssn_text = F.aggregate(F.array(ssn), F.lit(""), lambda _, v: F.concat_ws("-", F.lpad((v["x"] + F.when(v["x"] >= 665, 2).otherwise(1)).cast("string"), 3, "0"), F.lpad((F.floor(v["y"] / 9_999) + 1).cast("string"), 2, "0"), F.lpad((v["y"] % 9_999 + 1).cast("string"), 4, "0")))
    day = _day(m)
    moved = permute_number(F.floor(day / CYCLE_B), day % CYCLE_B, CYCLE_A, CYCLE_B, key, "date", inverse)
    date = F.aggregate(F.array(moved), F.lit(""), lambda _, v: F.date_format(F.date_add(F.lit("1800-01-01").cast("date"), (v["x"] * CYCLE_B + v["y"]).cast("int")), "yyyy-MM-dd"))
    dated = F.when(m.rlike("^[0-9]{4}-"), date).otherwise(F.regexp_replace(date, "^(....)-(..)-(..)$", "$3-$2-$1"))
    dated = F.when(m.contains("/"), F.regexp_replace(dated, "-", "/")).when(m.contains("."), F.regexp_replace(dated, "-", ".")).otherwise(dated)
    name, top = _part(m, r"^(.*)(\.[A-Za-z]+)$", 1), _part(m, r"^(.*)(\.[A-Za-z]+)$", 2)
    cases = {
        "date": F.coalesce(dated, m),
        "ssn": _checked(m, (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0), ssn_text),
        "phone": phone,
    }
    if runs:
        cases["ipv4"] = _checked(m, F.greatest(*octets) < 256, ip_text)
        cases["card"] = _run(m, key, inverse)
        cases["iban"] = _iban(m, key, inverse)
        cases["secret"] = permute_text(m, key, "secret", hexa, inverse)
    out = F.when(m.contains("@"), F.concat(permute_text(name, key, "email", plain, inverse), top)) if runs else F.when(F.lit(False), m)
    for kind, value in cases.items():
        out = out.when(m.rlike(rf"^(?:{FORMATS[kind]})$"), value)
    return out.otherwise(m)


def pseudonymise(df: DataFrame, key: str, text_col: str = "text", found_col: str | None = "n_replaced", inverse: bool = False) -> DataFrame:
    """df with text_col rewritten, and found_col int (unless None): how many values were replaced."""
    src = without(df, [found_col]) if found_col else df
    names = src.columns
    text = F.col(f"`{text_col}`")
    had = "__tessera_found"
    made = src.withColumn(had, F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), 0)))
    some = F.size(had) > 0
    new = "__tessera_new"
    made = made.withColumn(new, F.when(some, F.transform(had, lambda m: pseudonym(m, key, inverse))))
    gaps = F.split(text, ANY, -1)
    joined = F.array_join(F.flatten(F.zip_with(gaps, F.concat(F.col(new), F.array(F.lit(""))), lambda g, m: F.array(g, m))), "")
    changed = F.when(some, F.size(F.filter(F.zip_with(had, new, lambda a, b: a != b), lambda x: x))).otherwise(0)
    out = [F.when(some, joined).otherwise(text).alias(c) if c == text_col else F.col(f"`{c}`") for c in names]
    return made.select(*out, *([changed.cast("int").alias(found_col)] if found_col else []))


#: The key of the registered query; a deployment passes its own.
DEMO_KEY = "tessera-demo-key"


def op8_feistel_pii(spark, sf_dir: str) -> DataFrame:
    """Every document with its personal data pseudonymised, and how many values that were."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymise(docs, DEMO_KEY)
