"""Format-preserving pseudonyms for personal numbers, dates, addresses and keys. DataFrame functions only.

Values that pass their format's validation are replaced by a keyed permutation within that format,
so equal values get equal pseudonyms in every document, different values different ones, and the
text keeps its length. A value becomes a list of (v, m) digits, each v below its own modulus m; an
alternating Feistel network of ``ROUNDS`` rounds adds, modulo m, a SHA-256 of the key, the kind, the
round and the other half. What is permuted, and what stays:

========  =======================================================  ==================================
kind      valid when                                               permuted
========  =======================================================  ==================================
card      13-19 digits with a Luhn sum of 0: plain, 4-6-5, 4-4-4-4  all digits but the last, which is
          or that or 4-4-4 and 1-3 digits; the longest that fits   set to the new check digit
phone     North American number with country or area code          10 digits (2-9 stays 2-9 where the
          (``N`` positions 2-9)                                    plan asks for it)
intl      ``+`` country code and 7 to 12 digits, in groups or one;  digits after the country code
          without a separator up to 15 digits with the code
ssn       with - or spaces; area not 000, 666 or 9xx, group not    rank among the valid numbers
          00, serial not 0000
date      a day of the calendar (year first, day first with . or   day within its 400-year cycle
          /, month first with / where no such day exists)
ipv4      four octets                                              each octet among those as long
email     local part and a domain with a dot                       letters and digits before the ``@``
secret    the value after password, token, api key = or            letters and digits (hex stays hex),
          authorization: bearer, up to white space, a quote,       in blocks of ``SECRET_BLOCK``
          comma or bracket, of any length
akia      ``AKIA`` and 16 capitals or digits                       the 16
========  =======================================================  ==================================

Candidates that fail their check stay as they are. A one-digit half still gets a keyed shift.
Defined cases: a null text stays null, an empty one empty; very long texts are searched whole; rows are judged one by
one, so equal rows change alike; an empty table gives no rows; other columns pass through untouched, whatever their
names (where one is named like the count of replaced values, the new column has an underscore in front).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultweave.llm.common import fresh, table

#: session setting of the key, and the key of tests and check runs, which protects nothing
KEY_CONF, KEY = "spark.vaultweave.pii.key", "set-your-own-key"
ROUNDS = 8
#: characters of a secret that are permuted together; a longer value is cut into blocks, each keyed by its place
SECRET_BLOCK = 200

#: a group of digits is not taken where another value starts with it
_NO_DATE = (r"(?! (?:[0-9]{4}-(?:0[1-9]|1[0-2])-[0-3][0-9]|[0-3][0-9][./][01][0-9][./][0-9]{4}|[0-9]{1,2}/[0-9]{1,4}|[0-9]{3}-[0-9]{2}-[0-9]{4}"
            r"|\([2-9][0-9]{2}\) ?[2-9][0-9]{2}[ .-][0-9]{4}|[2-9][0-9]{2}[.-][2-9][0-9]{2}[.-][0-9]{4}"
            r"|[0-9]{1,3}(?:\.[0-9]{1,3}){3}|[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{13,19})(?![0-9]))")


def _grouped(sep: str) -> str:
    """Digit groups that may hold cards: 4-6-5, a run of fours with up to three digits after it, or four fours.
    ``_card`` finds the cards in a run."""
    four = f"{sep}(?![0-9]{{4}}(?:-[0-9]{{2}}-[0-9]{{2}}(?![0-9])|{' -'.replace(sep, '')}[0-9]{{4}}|[ -][0-9]{{6}}[ -][0-9]{{5}}(?![0-9])))[0-9]{{4}}(?![0-9])"
    tail = f"{sep}[0-9]{{1,3}}(?![0-9]|[./-][0-9])"
    return (f"[0-9]{{4}}{sep}[0-9]{{6}}{sep}[0-9]{{5}}(?![0-9])|[0-9]{{4}}(?:{four}){{2}}(?:(?:{four})++(?:{tail})?|{tail})"
            f"|[0-9]{{4}}(?:{sep}[0-9]{{4}}){{3}}(?![0-9])")


# fixed values: formats, in the order in which they are tried at a place in the text
PATTERNS = {
    "secret": r"(?i:(?<![a-z])(?:(?:password|passwd|pwd|secret|token|api[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}|authorization[\"']?\s{0,3}[=:]\s{0,3}[\"']?bearer\s{1,3})[\"']?"
              r"[^\s\"'`,;&<>()\[\]{}]{8,}+)",
    "akia": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9]|[./-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])|(?<![0-9.-]|[0-9] )[0-9]{3} [0-9]{2} [0-9]{4}(?![0-9]|[ .-][0-9])",
    "ipv4": r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9]|\.[0-9])",
    "phone": r"(?<![0-9])(?:\+?1[ .-]?)?\([2-9][0-9]{2}\) ?[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9])"
             r"|(?<![0-9.-])(?:\+?1[ .-])?[2-9][0-9]{2}[.-][2-9][0-9]{2}[.-][0-9]{4}(?![0-9]|[.-][0-9])"
             r"|(?<![0-9.-]|[0-9] )[2-9][0-9]{2} [2-9][0-9]{2} [0-9]{4}(?![0-9]|[ .-][0-9])"
             r"|(?<![0-9])\+1 ?[2-9][0-9]{2} ?[2-9][0-9]{2} ?[0-9]{4}(?![0-9])",
    "intl": r"(?<![0-9])\+[2-9](?:[0-9]{7,14}|[0-9]{0,2}[ .-]\(?[0-9]{7,12}\)?|[0-9]{0,2}[ .-]\(?[0-9]{1,12}\)?(?:" + _NO_DATE + r"[ .-]\(?[0-9]{1,12}\)?){1,4})(?![0-9])",
    "card": r"(?<![0-9.])(?:[0-9]{13,19}(?![0-9]|\.[0-9])|" + "|".join(_grouped(sep) for sep in " -") + ")",
}
#: kinds that start at a letter or digit after another character, and those that start at a digit, ``+`` or ``(``;
#: the leading look-arounds turn most places of a text away at once
_WORDS, _NUMBERS = ("secret", "akia", "email"), ("date", "ssn", "ipv4", "phone", "intl", "card")
ANY = ("(?:(?<![A-Za-z0-9])(?=[A-Za-z0-9._%+-])(?:" + "|".join(PATTERNS[k] for k in _WORDS) + ")|(?=[0-9+(])(?:"
       + "|".join(PATTERNS[k] for k in _NUMBERS) + "))")
#: every candidate holds one of these
_HINT = "[0-9@=:]"
DIGITS, LOWER, UPPER, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once, however often ``then`` uses it."""
    return F.transform(F.array(value), then).getItem(0)


def feistel(parts: Column, kind: str | Column, key: str) -> Column:
    """``parts`` (array of structs v, m) with each v permuted below its m."""

    def once(acc: Column, rnd: Column) -> Column:
        half = F.floor(F.size(acc) / 2).cast("int")
        side = F.when(rnd % 2 == 0, F.slice(acc, half + 1, F.size(acc) - half)).otherwise(F.slice(acc, F.lit(1), half))
        other = F.array_join(F.transform(side, lambda x: x["v"].cast("string")), ",")
        digest = lambda o, i: F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), rnd, i, o), 256)
        add = lambda o, x, i: F.conv(F.substring(digest(o, i), 1, 12), 16, 10).cast("long") % x["m"]
        return _let(other, lambda o: F.transform(acc, lambda x, i: F.when(
            (i < half) == (rnd % 2 == 0), F.struct(((x["v"] + add(o, x, i)) % x["m"]).alias("v"), x["m"].alias("m"))).otherwise(x)))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), parts, once)


def _num(c: Column) -> Column:
    return c.cast("long")


def _pair(v: Column, m) -> Column:
    return F.struct(_num(v).alias("v"), _num(m if isinstance(m, Column) else F.lit(m)).alias("m"))


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _spelled(s: Column, alphabets: list[str], kind: str | Column, key: str) -> Column:
    """Each character of ``s`` that is in one of the alphabets, permuted within it; the others stay."""
    alphabet = lambda c: F.coalesce(*[F.when(F.lit(a).contains(c), F.lit(a)) for a in alphabets])
    live = F.filter(_chars(s), lambda c: alphabet(c).isNotNull())
    sent = lambda v: feistel(F.transform(v, lambda c: _pair(F.position(c, alphabet(c)) - 1, F.char_length(alphabet(c)))), kind, key)
    got = _let(live, lambda v: F.array_join(F.zip_with(v, sent(v), lambda c, x: F.substr(alphabet(c), (x["v"] + 1).cast("int"), F.lit(1))), ""))
    return _laid(s, got, "[" + "".join(sorted(set("".join(alphabets)))) + "]")


def _laid(s: Column, new: Column, what: str) -> Column:
    """``s`` with the characters that match ``what`` replaced, in order, by those of ``new``."""
    step = lambda acc, c: F.when(c.rlike(what), F.struct(
        F.concat(acc["out"], F.substr(acc["new"], acc["at"], F.lit(1))).alias("out"), (acc["at"] + 1).alias("at"), acc["new"].alias("new"))).otherwise(
            F.struct(F.concat(acc["out"], c).alias("out"), acc["at"].alias("at"), acc["new"].alias("new")))
    first = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"), new.alias("new"))
    return F.aggregate(_chars(s), first, step, lambda acc: acc["out"])


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string whose last digit is the check digit."""
    back = F.reverse(_chars(digits))
    one = lambda c, i: F.when(i % 2 == 0, _num(c)).otherwise(F.when(_num(c) > 4, _num(c) * 2 - 9).otherwise(_num(c) * 2))
    return F.aggregate(F.transform(back, one), F.lit(0).cast("long"), lambda a, x: a + x)


#: the layouts of a card, and how many groups they have, the longest first
_LAYOUTS = "^(?:[0-9]{13,19}|" + "|".join(f"[0-9]{{4}}(?:{c}[0-9]{{4}}){{3}}(?:{c}[0-9]{{1,3}})?|[0-9]{{4}}(?:{c}[0-9]{{4}}){{2}}{c}[0-9]{{1,3}}|[0-9]{{4}}{c}[0-9]{{6}}{c}[0-9]{{5}}" for c in " -") + ")$"
_GROUPS = (5, 4, 3, 1)


def _one_card(s: Column, key: str) -> Column:
    digits = F.regexp_replace(s, "[^0-9]", "")
    head = F.substr(digits, F.lit(1), F.char_length(digits) - 1)
    sent = F.array_join(F.transform(feistel(F.transform(_chars(head), lambda c: _pair(c, 10)), "card", key), lambda x: x["v"].cast("string")), "")
    whole = _let(sent, lambda d: F.concat(d, ((F.lit(10) - _luhn(F.concat(d, F.lit("0"))) % 10) % 10).cast("string")))
    return _laid(s, whole, "[0-9]")


def _card(s: Column, key: str) -> Column:
    """At each group of ``s`` the longest layout with a Luhn sum of 0 is a card; groups of none stay."""
    def parts(groups: Column, seps: Column) -> Column:
        piece = lambda i, n: F.substr(F.array_join(F.flatten(F.zip_with(F.slice(seps, i, n), F.slice(groups, i, n), lambda a, g: F.array(a, g))), ""),
                                      F.char_length(F.element_at(seps, i)) + 1)
        valid = lambda x: x.rlike(_LAYOUTS) & (_luhn(F.regexp_replace(x, "[^0-9]", "")) % 10 == 0)
        fits = lambda i: F.get(F.filter(F.array(*[F.lit(n) for n in _GROUPS]), lambda n: (i + n - 1 <= F.size(groups)) & valid(piece(i, n))), F.lit(0))
        first = F.struct(F.array().cast("array<string>").alias("out"), F.lit(1).alias("next"))
        step = lambda acc, i: F.when(i < acc["next"], acc).otherwise(_let(fits(i), lambda n: F.struct(
            F.concat(acc["out"], F.array(F.element_at(seps, i), F.when(n.isNotNull(), _one_card(piece(i, n), key)).otherwise(F.element_at(groups, i)))).alias("out"),
            (i + F.coalesce(n, F.lit(1))).alias("next"))))
        return F.aggregate(F.sequence(F.lit(1), F.size(groups)), first, step, lambda acc: F.array_join(acc["out"], ""))

    return _let(F.regexp_extract_all(s, F.lit("[0-9]+"), F.lit(0)), lambda g: _let(F.split(s, "[0-9]+"), lambda b: parts(g, b)))


def _phone(s: Column, key: str) -> Column:
    digits = F.regexp_replace(s, "[^0-9]", "")
    lead = F.substr(digits, F.lit(1), F.char_length(digits) - 10)
    parts = F.transform(_chars(F.substr(digits, F.char_length(digits) - 9, F.lit(10))),
                        lambda c, i: F.when(i.isin(0, 3), _pair(_num(c) - 2, 8)).otherwise(_pair(c, 10)))
    sent = F.transform(feistel(parts, "phone", key), lambda x: F.when(x["m"] == 8, x["v"] + 2).otherwise(x["v"]).cast("string"))
    return _laid(s, F.concat(lead, F.array_join(sent, "")), "[0-9]")


#: country codes of one and two digits; all others have three
_CODE = r"^\+(?:7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"


def _intl(s: Column, key: str) -> Column:
    """The most groups after the country code that make a number; groups behind it stay."""
    plain = s.rlike(r"^\+[0-9]+$")
    code = F.when(plain, F.regexp_extract(s, _CODE, 0)).otherwise(F.regexp_extract(s, r"^\+[0-9]+", 0))

    def spelled(c: Column) -> Column:
        rest = F.substr(s, F.char_length(c) + 1)
        most = F.when(plain, F.lit(16) - F.char_length(c)).otherwise(F.lit(12))  # E.164: 15 digits with the code
        heads = lambda groups: F.transform(F.sequence(F.size(groups), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(groups, F.lit(1), n), ""))
        fits = lambda h: F.char_length(F.regexp_replace(h, "[^0-9]", "")).between(F.lit(7), most)
        head = F.get(F.filter(_let(F.regexp_extract_all(rest, F.lit(r"[ .-]?\(?[0-9]+\)?"), F.lit(0)), heads), fits), F.lit(0))
        return _let(head, lambda h: F.when(h.isNotNull(), F.concat(c, _spelled(h, [DIGITS], "intl", key), F.substr(rest, F.char_length(h) + 1))).otherwise(s))

    return _let(code, spelled)


def _ssn(s: Column, key: str) -> Column:
    area, group, serial = _num(F.substr(s, F.lit(1), F.lit(3))), _num(F.substr(s, F.lit(5), F.lit(2))), _num(F.substr(s, F.lit(8), F.lit(4)))
    ok = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    parts = F.array(_pair(F.when(area > 666, area - 2).otherwise(area - 1), 898), _pair(group - 1, 99), _pair(serial - 1, 9999))
    v = lambda x, i: x.getItem(i)["v"]
    sep = F.substr(s, F.lit(4), F.lit(1))
    new = _let(feistel(parts, "ssn", key), lambda x: F.concat(
        F.lpad(F.when(v(x, 0) >= 665, v(x, 0) + 2).otherwise(v(x, 0) + 1).cast("string"), 3, "0"),
        sep, F.lpad((v(x, 1) + 1).cast("string"), 2, "0"), sep, F.lpad((v(x, 2) + 1).cast("string"), 4, "0")))
    return F.when(ok, new).otherwise(s)


#: days in 400 years, 189 * 773, counted from 1600-01-01
_CYCLE, _ROWS, _START = 146097, 773, "1600-01-01"


def _date(s: Column, key: str) -> Column:
    iso = s.rlike("^[0-9]{4}")
    sep = F.when(s.contains("."), F.lit(".")).when(s.contains("/"), F.lit("/")).otherwise(F.lit("-"))
    plain = F.translate(s, "./", "--")
    first = F.try_to_date(plain, "dd-MM-yyyy")
    monthly = ~iso & first.isNull() & s.contains("/")           # no such day: the month stands first
    day = F.when(iso, F.try_to_date(plain, "yyyy-MM-dd")).when(monthly, F.try_to_date(plain, "MM-dd-yyyy")).otherwise(first)
    ok = day.isNotNull() & (F.year(day).between(1600, 9599))  # the whole cycles of four-digit years
    n = F.datediff(day, F.lit(_START).cast("date"))
    at = n % _CYCLE
    sent = feistel(F.array(_pair(F.floor(at / _ROWS), _CYCLE // _ROWS), _pair(at % _ROWS, _ROWS)), "date", key)
    new = _let(sent, lambda x: F.date_add(F.lit(_START).cast("date"), (n - at + x.getItem(0)["v"] * _ROWS + x.getItem(1)["v"]).cast("int")))
    part = lambda d, *fields: F.concat_ws("", *[x for f in fields for x in (sep, F.date_format(d, f))][1:])
    text = lambda d: F.when(iso, part(d, "yyyy", "MM", "dd")).when(monthly & (F.dayofmonth(d) > 12), part(d, "MM", "dd", "yyyy")).otherwise(part(d, "dd", "MM", "yyyy"))
    return F.when(ok, _let(new, text)).otherwise(s)


def _ipv4(s: Column, key: str) -> Column:
    octets = F.split(s, r"\.")
    ok = F.forall(octets, lambda o: (_num(o) <= 255) & ((F.char_length(o) == 1) | ~o.startswith("0")))
    low = lambda o: F.when(F.char_length(o) == 1, F.lit(0)).when(F.char_length(o) == 2, F.lit(10)).otherwise(F.lit(100))
    many = lambda o: F.when(F.char_length(o) == 1, F.lit(10)).when(F.char_length(o) == 2, F.lit(90)).otherwise(F.lit(156))
    sent = feistel(F.transform(octets, lambda o: _pair(_num(o) - low(o), many(o))), "ipv4", key)
    new = F.array_join(F.zip_with(octets, sent, lambda o, x: (x["v"] + low(o)).cast("string")), ".")
    return F.when(ok, new).otherwise(s)


def _email(s: Column, key: str) -> Column:
    at = F.instr(s, "@")
    return F.concat(_spelled(F.substr(s, F.lit(1), at - 1), [DIGITS, LOWER, UPPER], "email", key), F.substr(s, at, F.char_length(s)))


def _secret(s: Column, key: str) -> Column:
    name = F.regexp_extract(s, r"(?i)^[a-z_-]+[\"']?\s*[=:]\s*(?:[\"']?bearer\s+)?[\"']?", 0)
    value = F.substr(s, F.char_length(name) + 1, F.char_length(s))
    blocks = F.regexp_extract_all(value, F.lit(f"(?s).{{1,{SECRET_BLOCK}}}"), F.lit(0))
    each = lambda alphabets, kind: F.array_join(F.transform(blocks, lambda b, i: _spelled(
        b, alphabets, F.when(i == 0, F.lit(kind)).otherwise(F.concat_ws(" ", F.lit(kind), i)), key)), "")
    return F.concat(name, F.when(value.rlike("^[0-9a-f]+[^0-9A-Za-z]*$"), each([HEX], "hex")).otherwise(each([DIGITS, LOWER, UPPER], "secret")))


def _akia(s: Column, key: str) -> Column:
    return F.concat(F.lit("AKIA"), _spelled(F.substr(s, F.lit(5), F.lit(16)), [DIGITS, UPPER], "akia", key))


_KINDS = {"secret": _secret, "akia": _akia, "email": _email, "date": _date, "ssn": _ssn, "ipv4": _ipv4, "phone": _phone, "intl": _intl, "card": _card}


def pseudonym(value: Column, key: str = KEY) -> Column:
    """The pseudonym of one matched value; the value itself when no kind finds it valid."""
    out = value
    for kind in reversed(_KINDS):
        out = F.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), _KINDS[kind](value, key)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, text_col: str = "text", key: str | None = None, count_col: str | None = None) -> DataFrame:
    """``docs`` with the values in ``text_col`` replaced; ``count_col`` adds how many changed. ``key``: the secret that the
    permutations depend on; without it the session's ``KEY_CONF``, and without that the test key ``KEY``. Texts without a
    candidate pass through after one scan."""
    key = key or docs.sparkSession.conf.get(KEY_CONF, KEY)
    text = F.col(text_col)
    hits, new = fresh(docs.columns, "__hits", "__new")
    found = docs.withColumn(hits, F.when(text.rlike(_HINT), F.regexp_extract_all(text, F.lit(ANY), 0)))
    has = F.coalesce(F.size(hits) > 0, F.lit(False))
    found = found.withColumn(new, F.when(has, F.transform(hits, lambda v: pseudonym(v, key))))
    between = F.split(text, ANY)
    # one more piece than there are hits
    joined = F.array_join(F.flatten(F.zip_with(between, F.col(new), lambda b, v: F.array(b, F.coalesce(v, F.lit(""))))), "")
    changed = F.size(F.filter(F.zip_with(hits, new, lambda a, b: a != b), lambda x: x))
    names = {c.lower(): c for c in docs.columns}
    count = [F.when(has, changed).otherwise(F.lit(0)).cast("long").alias(fresh(docs.columns, count_col)[0])] if count_col else []
    return found.select(*[F.when(has, joined).otherwise(text).alias(c) if c == names[text_col.lower()] else F.col(f"`{c}`") for c in docs.columns], *count)


def op9_format_preserving_pii(spark, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents"), count_col="n_replaced")
