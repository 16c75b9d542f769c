"""Format-preserving pseudonyms by a keyed Feistel network, in DataFrame
functions only.

A single pattern finds candidates, each kind is validated, and a valid value
is permuted within its own format:

* card: 13 to 19 digits that pass the Luhn test; the digits before the last
  are permuted and the check digit is made anew, so the result passes too;
* account: another lone run of 13 to 19 digits, permuted digit by digit;
* phone: ten digits of the North American plan, where the first digit of area
  and exchange stays within 2-9; after +1 any ten digits, and there a first
  digit 0 or 1 stays within 0-1, so a number has one pseudonym with and without
  its prefix and no two numbers share one;
* ssn: ddd-dd-dddd of the areas 001-899; the area stays within them;
* ip: four numbers of 0-255, permuted as two 16-bit halves;
* date: a day that exists in the 400 years from 1800, permuted over those
  146,097 days; one day has one pseudonym in all its spellings; slashes are
  month/day/year, or day/month/year where that is no date;
* email: the letters and digits of the local part, with the domain as tweak;
* key, secret: access keys and the value of a password or token assignment.

The permutation is a bijection per kind and key, so equal values stay linked
across documents and different values stay different.  Characters outside the
values are untouched; a value that fails its validation stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 8  # even, so both halves end where they began
# The key comes from this session setting.  The example key is public: with it, anyone can undo the pseudonyms.
KEY_SETTING, EXAMPLE_KEY = "spark.tickflow.pii.key", "tickflow-example-key"

# The alphabets a character can move in.
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Stand-ins for digits confined to the eight values 2-9.
EIGHT = "αβγδεζηθ"
# Stand-ins for the digits 0 and 1 where a phone's area or exchange begins with them.
TWO = "ικ"
CLASSES = (DIGITS, LOWER, UPPER, EIGHT, TWO)

# Days of 400 Gregorian years = 189 * 773, so the two Feistel halves cover them exactly.
FIRST_DAY, DAY_HIGH, DAY_LOW = "1800-01-01", 189, 773
# Areas 001-899 of an ssn, and what may follow an area.
SSN_AREAS, SSN_REST = 899, 1_000_000

_EDGE = r"(?<![\p{L}\p{N}_])"
_END = r"(?![\p{L}\p{N}_])"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9][A-Za-z0-9._%+\-]*+@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,}",
    "secret": r"(?i:password|passwd|secret|token|api_key)[ ]?[=:][ ]?\"?[A-Za-z0-9]{12,}+\"?",
    "key": _EDGE + r"AKIA[A-Z0-9]{16}" + _END,
    "ip": r"(?<![\p{L}\p{N}_.])\d{1,3}+(?:\.\d{1,3}+){3}(?![\p{L}\p{N}_]|\.\d)",
    "date": _EDGE + r"(?:\d{4}[\-/]\d{2}[\-/]\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})" + _END,
    "ssn": r"(?<![\p{L}\p{N}_\-])(?!000)[0-8]\d\d-\d\d-\d{4}(?![\p{L}\p{N}_\-])",
    "phone": r"(?<![\p{L}\p{N}_\-])\+1[ .\-]?(?:\(\d{3}\) ?|\d{3}[ .\-])\d{3}[ .\-]\d{4}(?!\d)|"
             r"(?:(?<![\p{L}\p{N}_\-])\+?1[ .\-]?)?(?:\([2-9]\d\d\) ?|(?<![\p{L}\p{N}_])[2-9]\d\d[ .\-])"
             r"[2-9]\d\d[ .\-]\d{4}(?!\d)",
    "card": r"(?<![\p{L}\p{N}_\-])\d(?:[ \-]?\d){12,18}(?![\p{L}\p{N}_\-])",
}
PATTERN = "|".join(PATTERNS.values())
KINDS = tuple(PATTERNS)


def key_of(spark: SparkSession) -> str:
    """The session's key; the example key where none is set, as in the checks."""
    return spark.conf.get(KEY_SETTING, EXAMPLE_KEY)


def _noise(key: str, kind: str, turn: Column, half: Column, tweak: Column | None = None) -> Column:
    """Keyed hex digest of a round: 64 characters."""
    parts = [F.lit(f"{key}\x1f{kind}\x1f"), turn.cast("string"), F.lit("\x1f"), half]
    return F.sha2(F.concat(*parts, *([F.lit("\x1f"), tweak] if tweak is not None else [])), 256)


def _hex(digest: Column, start: Column | int, size: int) -> Column:
    at = F.lit(start) if isinstance(start, int) else start
    return F.conv(F.substr(digest, at, F.lit(size)), 16, 10).cast("long")


def _shifted(half: Column, noise: Column) -> Column:
    """Each character of ``half`` moved within its alphabet by the noise, which
    is hashed on for every 16 characters beyond the first."""
    def move(c, i):
        block = F.floor(i / 16)
        fresh = F.when(block == 0, noise).otherwise(F.sha2(F.concat(noise, block.cast("string")), 256))
        shift = _hex(fresh, (i % 16) * 4 + 1, 4)
        out = c
        for alphabet in CLASSES:
            at = F.instr(F.lit(alphabet), c)
            out = F.when(at > 0, F.substr(F.lit(alphabet), ((at - 1 + shift) % len(alphabet) + 1).cast("int"),
                                          F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.regexp_extract_all(half, F.lit("(?s)."), F.lit(0)), move), "")


def permuted(text: Column, key: str, kind: str, tweak: Column | None = None) -> Column:
    """Feistel network over the characters of ``text``: the halves take turns,
    each character moving within its alphabet by a keyed hash of the other half."""
    cut = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substr(text, F.lit(1), cut).alias("a"),
                     F.substr(text, cut + 1, F.length(text)).alias("b"))
    done = F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), start,
        lambda acc, r: F.struct(acc["b"].alias("a"),
                                _shifted(acc["a"], _noise(key, kind, r, acc["b"], tweak)).alias("b")),
        lambda acc: F.concat(acc["a"], acc["b"]))
    return done


def _permuted_number(high: Column, low: Column, mod_high: int, mod_low: int, key: str, kind: str) -> Column:
    """Feistel network over a pair of numbers below their moduli; returns
    high * mod_low + low."""
    def turn(acc, r):
        odd = r % 2 == 1
        step = _hex(_noise(key, kind, r, F.when(odd, acc["l"]).otherwise(acc["h"]).cast("string")), 1, 12)
        return F.struct(F.when(odd, (acc["h"] + step) % mod_high).otherwise(acc["h"]).alias("h"),
                        F.when(odd, acc["l"]).otherwise((acc["l"] + step) % mod_low).alias("l"))

    start = F.struct(high.cast("long").alias("h"), low.cast("long").alias("l"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda acc: acc["h"] * mod_low + acc["l"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by ``digits``."""
    gaps = F.split(shape, "[0-9]", -1)
    return F.array_join(F.transform(gaps, lambda g, i: F.concat(
        g, F.coalesce(F.substr(digits, (i + 1).cast("int"), F.lit(1)), F.lit("")))), "")


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum of the digits read from the right; positions of the parity
    ``doubled`` count twice."""
    return F.aggregate(
        F.transform(F.regexp_extract_all(F.reverse(digits), F.lit("."), F.lit(0)), lambda c, i: F.when(
            i % 2 == doubled, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int"))
            .otherwise(c.cast("int"))), F.lit(0), lambda acc, x: acc + x)


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    body = permuted(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card")
    with_check = F.transform(F.array(body), lambda b: F.concat(
        b, ((10 - _luhn_sum(b, 0) % 10) % 10).cast("string")))[0]
    valid = _luhn_sum(digits, 1) % 10 == 0
    return _refill(value, F.when(valid, with_check).otherwise(permuted(digits, key, "account")))


def _phone(value: Column, key: str) -> Column:
    digits = _digits(value)
    ten = F.right(digits, F.lit(10))
    # the first digit of area and exchange stands among the eight values of the plan, or the other two
    first, stand_ins = "2345678901", EIGHT + TWO
    held = F.concat(F.translate(F.substr(ten, F.lit(1), F.lit(1)), first, stand_ins),
                    F.substr(ten, F.lit(2), F.lit(2)),
                    F.translate(F.substr(ten, F.lit(4), F.lit(1)), first, stand_ins),
                    F.substr(ten, F.lit(5), F.lit(6)))
    out = F.translate(permuted(held, key, "phone"), stand_ins, first)
    return _refill(value, F.concat(F.substr(digits, F.lit(1), F.length(digits) - 10), out))


def _ssn(value: Column, key: str) -> Column:
    digits = _digits(value)
    area, rest = F.substr(digits, F.lit(1), F.lit(3)).cast("int") - 1, F.substr(digits, F.lit(4), F.lit(6)).cast("int")
    n = _permuted_number(area, rest, SSN_AREAS, SSN_REST, key, "ssn")
    return _refill(value, F.lpad((n + SSN_REST).cast("string"), 9, "0"))


def _ip(value: Column, key: str) -> Column:
    part = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))
    valid = F.forall(part, lambda x: x <= 255)
    n = _permuted_number(part[0] * 256 + part[1], part[2] * 256 + part[3], 65536, 65536, key, "ip")
    out = F.transform(F.array(n), lambda x: F.concat_ws(".", *[
        F.shiftright(x, s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)]))[0]
    return F.when(valid, out).otherwise(value)


def _date(value: Column, key: str) -> Column:
    """Year first; day.month.year; month/day/year, or day/month/year if that is
    no date.  A day/month date is written so again where its new day is over 12,
    and month/day otherwise: read by the same rule it is always the new day, so
    two days never share a pseudonym."""
    def cut(start, size):
        return F.substr(value, F.lit(start), F.lit(size))

    year_first = value.rlike(r"^\d{4}")
    dotted = F.contains(value, F.lit("."))
    iso = F.when(year_first, F.concat_ws("-", cut(1, 4), cut(6, 2), cut(9, 2))) \
        .when(dotted, F.concat_ws("-", cut(7, 4), cut(4, 2), cut(1, 2))) \
        .otherwise(F.concat_ws("-", cut(7, 4), cut(1, 2), cut(4, 2)))
    slashed = F.contains(value, F.lit("/")) & ~year_first
    day_first = F.when(slashed & (cut(1, 2) > "12"), F.concat_ws("-", cut(7, 4), cut(4, 2), cut(1, 2)))
    day = F.datediff(F.coalesce(day_first, iso).try_cast("date"), F.lit(FIRST_DAY).cast("date"))
    span = DAY_HIGH * DAY_LOW
    n = _permuted_number(F.floor(day / DAY_LOW), day % DAY_LOW, DAY_HIGH, DAY_LOW, key, "date")
    new = F.date_add(F.lit(FIRST_DAY).cast("date"), n.cast("int")).cast("string")

    def written(d):
        y, m, dd = (F.substr(d, F.lit(a), F.lit(b)) for a, b in ((1, 4), (6, 2), (9, 2)))
        mark = F.substr(value, F.lit(5), F.lit(1))
        return F.when(year_first, F.concat(y, mark, m, F.substr(value, F.lit(8), F.lit(1)), dd)) \
            .when(dotted, F.concat_ws(".", dd, m, y)) \
            .when(day_first.isNotNull() & (dd > "12"), F.concat_ws("/", dd, m, y)).otherwise(F.concat_ws("/", m, dd, y))

    return F.when(day.between(0, span - 1), F.transform(F.array(new), written)[0]).otherwise(value)


def _email(value: Column, key: str) -> Column:
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    return F.concat(permuted(local, key, "email", F.lower(domain)), F.lit("@"), domain)


def _secret(value: Column, key: str) -> Column:
    name = F.regexp_extract(value, r"^[^=:]*[=:][ ]?\"?", 0)
    rest = F.substr(value, F.length(name) + 1, F.length(value))
    return F.concat(name, permuted(rest, key, "secret"))


def _key(value: Column, key: str) -> Column:
    return F.concat(F.lit("AKIA"), permuted(F.substr(value, F.lit(5), F.lit(16)), key, "key"))


_PSEUDONYM = {"email": _email, "secret": _secret, "key": _key, "ip": _ip, "date": _date, "ssn": _ssn,
              "phone": _phone, "card": _card}


def kind_of(value: Column) -> Column:
    """The kind whose pattern the value matches in full, first in order."""
    out = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        out = F.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), F.lit(kind)).otherwise(out)
    return out


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    out = value
    for name in KINDS:
        out = F.when(kind == name, _PSEUDONYM[name](value, key)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_found`` (values found), ``n_replaced``
    (values that changed), ``kinds`` (their kinds in order of place) and the
    ``text`` with its values replaced.

    A null text stays null and an empty one empty, with nothing found; a null
    id stays null; repeated rows give repeated results; a text of any length
    is read whole; other columns are not read.
    """
    df = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return masked(df, "text", key).select(
        F.col("id").alias(id_col), "n_found", "n_replaced", "kinds", F.col("masked").alias("text"))


def masked_documents(docs: DataFrame, key: str, text_col: str = "text",
                     chars_col: str | None = "n_chars") -> DataFrame:
    """All rows of ``docs`` with their columns; the text has its values
    replaced, and ``chars_col``, where there is one, follows its length."""
    df = masked(docs.select(F.struct("*").alias("row"), docs[text_col].cast("string").alias("text")), "text", key)
    row = F.col("row").withField(f"`{text_col}`", F.col("masked"))
    if chars_col in docs.columns:
        length = F.when(F.col("n_replaced") > 0, F.length("masked")).otherwise(F.col(f"row.`{chars_col}`"))
        row = row.withField(f"`{chars_col}`", length.cast(docs.schema[chars_col].dataType))
    return df.select(row.alias("row")).select("row.*")


def masked(df: DataFrame, text_col: str, key: str) -> DataFrame:
    """``df`` with ``masked``, ``n_found``, ``n_replaced`` and ``kinds``."""
    text = F.col(text_col)
    none = F.array().cast("array<string>")
    # every text is searched: secrets and keys need neither a digit nor an @
    found = F.coalesce(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), none)
    df = df.withColumn("__found", found)
    df = df.withColumn("__pairs", F.transform("__found", lambda v: F.struct(v.alias("v"), kind_of(v).alias("k"))))
    df = df.withColumn("__new", F.transform("__pairs", lambda p: pseudonym(p["v"], p["k"], key)))
    gaps = F.split(text, PATTERN, -1)
    joined = F.array_join(F.zip_with(gaps, F.col("__new"), lambda g, n: F.concat(g, F.coalesce(n, F.lit("")))), "")
    changed = F.filter(F.zip_with("__found", "__new", lambda a, b: a != b), lambda x: x)
    return (df.withColumn("masked", F.when(F.size("__found") > 0, joined).otherwise(text))
            .withColumn("n_found", F.coalesce(F.size("__found"), F.lit(0)).cast("long"))
            .withColumn("n_replaced", F.coalesce(F.size(changed), F.lit(0)).cast("long"))
            .withColumn("kinds", F.coalesce(F.transform("__pairs", lambda p: p["k"]), none))
            .drop("__found", "__pairs", "__new"))
