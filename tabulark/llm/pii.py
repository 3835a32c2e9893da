"""Operator 7: surrogates for personal data, in DataFrame functions only.

One pattern finds entities (mail addresses, secrets, IP addresses, card and
account numbers, phone numbers, names). A surrogate keeps the entity's format:
every letter stays a letter of its script and case, every digit a digit, all
punctuation stays. It is a keyed Feistel permutation of the entity's letters and
digits, so

* one entity gets one surrogate wherever it occurs (coreference), also in another
  format (phone and card numbers count by their digits, mail addresses in any case);
* two entities never share a surrogate (distinctness): the permutation maps each
  format onto itself one to one, words of a name that are no listed first name stay
  off that list, and lower-case secrets that are not hexadecimal stay so;
* ``check_surrogates`` checks both over a corpus by pre-aggregated counts and fails
  if an entity has two surrogates or a surrogate two entities; op7_pii and the
  pipeline run it;
* first names map to first names of the same gender by a keyed permutation of
  that list; card numbers that satisfy the Luhn check still do.

Replacing shuffles nothing (the check shuffles distinct entities): a text is split at its entities and put together again in
one projection, whatever the size of a source or a group of copies.

Defined results: a null text stays null with no entities; empty texts stay empty;
null ids pass through; repeated rows get equal results; other columns are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Alphabets of the scripts a surrogate keeps
ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
             "àáâãäåæçèéêëìíîïñòóôõöøùúûü", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜ",
             "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
             "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ")
# Common first names by gender
FEMALE = ("Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Jessica", "Sarah", "Karen",
          "Nancy", "Lisa", "Anna", "Maria", "Julia", "Laura", "Sophie", "Claire", "Emma", "Ursula")
MALE = ("James", "John", "Robert", "Michael", "William", "David", "Richard", "Joseph", "Thomas", "Charles",
        "Daniel", "Matthew", "Peter", "Paul", "Hans", "Pierre", "Carlos", "Juan", "Klaus", "Andrew")
# Titles before a name
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Señor", "Señora",
          "Madam", "Mme", "Signor", "Signora", "Sr", "Sra", "Господин", "Госпожа", "Доктор", "господин", "госпожа", "доктор",
          "г-н", "г-жа", "Κύριος", "Κυρία", "κύριος", "κυρία", "κ")

KEYWORD = r"(?i:token|secret|password|passwd|api[_ -]?key|access[_ -]?key) ?[=:] ?[\"']?"
FREE, CAPITAL = r"(?<![\p{L}\d_])", "(?=[A-ZГДгдΚκ])"   # no word before, and the first letters of titles and names
TITLE = rf"(?:{'|'.join(TITLES)})\.? "
MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}\b"
SECRET = (rf"(?<![A-Za-z0-9])(?=[tspaTSPA]){KEYWORD}[A-Za-z0-9+/_-]{{8,256}}"
          r"|\b(?=[a-f]{0,31}[0-9])[0-9a-f]{32,128}\b|\b(?=[spgA])(?:sk|pk|ghp|AKIA)[-_]?[A-Za-z0-9]{16,64}\b")
IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]?\d)"
IBAN = r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"
CARD = r"(?<![\d+])\d(?:[ -]?\d){12,18}(?![\d])"
SEP = r"[ ./\u00a0-]"
PHONE = (rf"(?<![\d+])\+\d{{1,3}}{SEP}?(?:\(\d{{1,4}}\){SEP}?)?\d{{2,4}}(?:{SEP}?\d{{2,4}}){{1,3}}(?!\d)"
         r"|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"
         r"|(?<![\d-])(?<!\d )\d{3}[ \u00a0]\d{3}[ \u00a0]\d{4}(?![\d-])(?! \d)"
         r"|(?<![\d.,/-])(?<!\d )0(?:\d(?:[ \u00a0]\d{2}){4}|\d{2,4}[ /]\d{3,7})(?![\d/-])(?! \d)")
NUMBER = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
WORDS = r"\p{Lu}[\p{L}'-]{1,40}"
NAME = (rf"{FREE}{CAPITAL}{TITLE}{WORDS}(?: {WORDS})?|\b(?=[A-Z])(?:{'|'.join(FEMALE + MALE)}) {WORDS}")
KINDS = (("mail", MAIL), ("secret", SECRET), ("ip", IP), ("number", NUMBER), ("iban", IBAN), ("card", CARD),
         ("phone", PHONE), ("name", NAME))
PATTERN = "|".join(f"(?:{p})" for _, p in KINDS)
# every entity has a digit, an @, a keyword, a title or a known first name
HINT = (rf"[0-9@]|{CAPITAL}{FREE}(?:{'|'.join((*TITLES, *FEMALE, *MALE))})(?![\p{{L}}\d_])"
        rf"|(?=[tspaTSPA])(?<![A-Za-z0-9]){KEYWORD}")
ROUNDS = 4
HEX, NOT_HEX = "abcdef", "ghijklmnopqrstuvwxyz"
# Country codes of one and two digits, all others have three; digits may have separators between them
COUNTRY = r"^\+(?:[17]|2\D*[07]|3\D*[0-469]|4\D*[013-9]|5\D*[1-8]|6\D*[0-6]|8\D*[1246]|9\D*[0-58]|\d\D*\d\D*\d)"


def kind_of(m: Column) -> Column:
    """The first kind whose pattern is the whole entity."""
    digits = F.length(F.regexp_replace(m, r"\D", ""))
    return (F.when(m.contains("@"), "mail")
            .when(m.rlike(rf"^{IP}$"), "ip")
            .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "number")
            .when(m.rlike(r"^\d(?:[ -]?\d){12,18}$"), "card")
            .when(m.rlike(r"^[+(\d][-+() ./\u00a0\d]*$") & (digits < 20), "phone")
            .when(m.rlike(rf"^(?:{IBAN})$"), "iban")
            .when(m.rlike(rf"^(?:{NAME})$"), "name")
            .otherwise("secret"))


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _feistel(units: Column, key: str, kind: Column) -> Column:
    """Keyed permutation of array<struct<v, size>> that keeps every unit's size.

    In each round one half moves by amounts that depend on the other half alone."""
    def round_(state, r):
        half = F.size(state) / 2
        moves = lambda i: (i < half) == (r % 2 == 0)
        still = F.array_join(F.transform(F.filter(state, lambda u, i: ~moves(i)), lambda u: u["v"].cast("string")), ",")
        return _bind(F.sha2(F.concat_ws("|", F.lit(key), kind, r.cast("string"), F.size(state).cast("string"), still), 512),
                     lambda h: F.transform(state, lambda u, i: F.struct(
                         F.when(moves(i), F.pmod(u["v"] + F.conv(F.substr(h, (i % 42) * 3 + 1, F.lit(3)), 16, 10).cast("int"), u["size"]))
                         .otherwise(u["v"]).alias("v"), u["size"].alias("size"))))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), units, round_)


def _alphabet(ch: Column) -> Column:
    """The alphabet of a character (null: none)."""
    return reduce(lambda acc, a: F.when(F.instr(F.lit(a), ch) > 0, a).otherwise(acc) if acc is not None
                  else F.when(F.instr(F.lit(a), ch) > 0, a), reversed(ALPHABETS), None)


def _letters(m: Column, norm: Column, key: str, kind: Column, hexes: Column | int = -1) -> Column:
    """``m`` with its letters and digits permuted; ``norm`` is ``m`` in the case that counts. Of the first ``hexes``
    characters a-f stay among themselves, and g-z right behind them."""
    def unit(ch, i):
        own = _alphabet(ch)
        return _bind(F.when((i < hexes) & ch.rlike("[a-f]"), HEX).when((i == hexes) & ch.rlike("[g-z]"), NOT_HEX).otherwise(own),
                     lambda a: F.struct(a.alias("a"), (F.instr(a, ch) - 1).alias("v"), F.length(a).alias("size")))
    chars = F.transform(F.split(norm, ""), lambda c, i: F.when(_alphabet(c).isNotNull(), unit(c, i)))

    def back(made):
        # the k-th permuted unit goes where the k-th letter or digit stood
        def put(acc, x):
            ch = F.element_at(made["alphabets"], acc["k"] + 1)
            new = F.substr(ch, F.element_at(made["moved"], acc["k"] + 1)["v"] + 1, F.lit(1))
            cased = F.when((x != F.lower(x)) & (new == F.lower(new)), F.upper(new)).otherwise(new)
            return F.when(_alphabet(x).isNull(), F.struct(F.concat(acc["s"], x).alias("s"), acc["k"].alias("k"))).otherwise(
                F.struct(F.concat(acc["s"], cased).alias("s"), (acc["k"] + 1).alias("k")))
        return F.aggregate(F.split(m, ""), F.struct(F.lit("").alias("s"), F.lit(0).alias("k")), put)["s"]

    return _bind(F.filter(chars, lambda u: u.isNotNull()), lambda u: _bind(
        F.struct(F.transform(u, lambda x: x["a"]).alias("alphabets"),
                 _feistel(F.transform(u, lambda x: F.struct(x["v"].alias("v"), x["size"].alias("size"))), key, kind).alias("moved")), back))


def _ip(m: Column, key: str) -> Column:
    units = F.transform(F.split(m, r"\."), lambda x: F.struct(x.cast("int").alias("v"), F.lit(256).alias("size")))
    return F.array_join(F.transform(_feistel(units, key, F.lit("ip")), lambda u: u["v"].cast("string")), ".")


def _luhn(digits: Column) -> Column:
    """Sum of a digit string as the Luhn check takes it, modulo 10."""
    both = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, F.when(
        c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")))
    return F.aggregate(both, F.lit(0), lambda a, v: a + v) % 10


def _card(m: Column, key: str) -> Column:
    """All digits but the last are permuted; the last keeps the number's Luhn remainder."""
    head, last = F.substr(m, F.lit(1), F.length(m) - 1), F.substr(m, F.length(m), F.lit(1))
    digits = F.regexp_replace(head, r"\D", "")
    return _bind(_letters(head, head, key, F.lit("card")), lambda new: F.concat(new, F.pmod(
        last.cast("int") + _luhn(F.concat(digits, F.lit("0"))) - _luhn(F.concat(F.regexp_replace(new, r"\D", ""), F.lit("0"))),
        F.lit(10)).cast("string")))


def _name(m: Column, key: str) -> Column:
    def word(w):
        out = F.when(F.lit(False), w)
        for gender, names in (("f", FEMALE), ("m", MALE)):      # a keyed order of the list, shifted by one
            keyed = sorted(names, key=lambda n: _digest(f"{key}|{gender}|{n}"))
            out = reduce(lambda acc, i: acc.when(w == keyed[i], keyed[(i + 1) % len(keyed)]), range(len(keyed)), out)
        # a result on the list is permuted on: in a cycle, at most the listed names of one length follow each other
        step = lambda x: _letters(x, x, key, F.lit("name"))
        listed = [*FEMALE, *MALE]
        most = max(sum(len(a) == len(b) for b in listed) for a in listed)
        return out.otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(most)), step(w), lambda x, _: F.when(
            x.isin(listed), step(x)).otherwise(x)))
    return F.array_join(F.transform(F.split(m, " "), word), " ")


def _digest(s: str) -> str:
    import hashlib
    return hashlib.sha256(s.encode()).hexdigest()


def surrogate(m: Column, kind: Column, key: str) -> Column:
    at = F.length(m) - F.instr(F.reverse(m), ".")              # a mail address keeps its top domain
    head, tail = F.substr(m, F.lit(1), at), F.substr(m, at + 1)
    country = F.regexp_extract(m, COUNTRY, 0)                   # a phone number keeps its country code
    local = F.substr(m, F.length(country) + 1)
    keyword = F.regexp_extract(m, rf"^{KEYWORD}", 0)             # a secret keeps what names it, a name its title
    value = F.substr(m, F.length(keyword) + 1)
    title = F.regexp_extract(m, rf"^{TITLE}", 0)
    hexes = F.when(value.rlike("^[0-9a-z]+$"), F.length(F.regexp_extract(value, "^[0-9a-f]*", 0))).otherwise(-1)
    return (F.when(kind == "mail", F.concat(_letters(head, F.lower(head), key, F.lit("mail")), tail))
            .when(kind == "ip", _ip(m, key))
            .when(kind == "card", _card(m, key))
            .when(kind == "phone", F.concat(country, _letters(local, local, key, F.lit("phone"))))
            .when(kind == "name", F.concat(title, _name(F.substr(m, F.length(title) + 1), key)))
            .when(kind == "secret", F.concat(keyword, _letters(value, value, key, F.lit("secret"), hexes)))
            .otherwise(_letters(m, m, key, kind)))


def identity(m: Column, kind: Column) -> Column:
    """What makes two mentions one entity."""
    return (F.when(kind == "mail", F.lower(m)).when(kind == "phone", F.regexp_replace(m, r"(?!^\+)\D", ""))
            .when(kind == "card", F.regexp_replace(m, r"\D", "")).when(kind == "iban", F.regexp_replace(m, " ", ""))
            .when(kind == "ip", F.array_join(F.transform(F.split(m, r"\."), lambda x: x.cast("int").cast("string")), "."))
            .when(kind == "secret", F.regexp_replace(m, rf"^{KEYWORD}", ""))
            .when(kind == "name", F.regexp_replace(m, rf"^{TITLE}", "")).otherwise(m))


def _entities(text: Column, key: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    kinds = F.transform(found, lambda m: F.struct(m.alias("original"), kind_of(m).alias("kind")))
    return F.transform(kinds, lambda e: F.struct(e["kind"].alias("kind"), e["original"].alias("original"),
                                                 surrogate(e["original"], e["kind"], key).alias("surrogate")))


def replace_pii(docs: DataFrame, key: str, text_col: str = "text", out: str = "pii") -> DataFrame:
    """The input's columns with surrogates in the text, plus ``out`` (in place of an input
    column of that name), the entities in order as array<struct<kind, original, surrogate>>. ``key`` is secret: who holds it
    can link surrogates to guesses."""
    text = F.col(text_col)
    names = [c for c in docs.columns if c != out]
    own = F.struct(*[F.col(c) for c in names]).alias("_row")
    # most texts hold none: a cheap search for what every entity has comes first
    x = docs.select(own, F.when(text.rlike(HINT), _entities(text, key)).otherwise(
        F.array().cast("array<struct<kind:string,original:string,surrogate:string>>")).alias("_pii"))
    t, e = F.col(f"_row.`{text_col}`"), F.col("_pii")
    gaps = F.split(t, PATTERN, -1)
    new = F.when(F.size(e) == 0, t).otherwise(F.array_join(F.transform(
        gaps, lambda g, i: F.concat(g, F.coalesce(F.get(e, i)["surrogate"], F.lit("")))), ""))
    x = x.select("_row", new.alias("_new"), "_pii")
    return x.select(*[F.col("_new").alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in names],
                    F.col("_pii").alias(out))


def _mentions(replaced: DataFrame, col: str = "pii") -> DataFrame:
    """Distinct ``kind, who, surrogate`` of a corpus."""
    return replaced.select(F.explode(col).alias("e")).select(
        F.col("e.kind").alias("kind"), identity(F.col("e.original"), F.col("e.kind")).alias("who"),
        identity(F.col("e.surrogate"), F.col("e.kind")).alias("surrogate")).distinct()


def surrogate_collisions(replaced: DataFrame) -> DataFrame:
    """Collision check over a corpus: ``kind, surrogate, entities`` of surrogates that stand
    for more than one entity (none, if all is well)."""
    return _mentions(replaced).groupBy("kind", "surrogate").agg(F.count("*").alias("entities")).filter("entities > 1")


def check_surrogates(replaced: DataFrame, col: str = "pii") -> DataFrame:
    """``replaced``, after one job over it that fails with ``ValueError`` if a surrogate stands for several
    entities or an entity has several surrogates. The message has kinds and counts, no values."""
    both = _mentions(replaced, col).select("kind", F.explode(F.array(
        F.struct(F.lit("surrogate with several entities").alias("what"), F.col("surrogate").alias("value")),
        F.struct(F.lit("entity with several surrogates").alias("what"), F.col("who").alias("value")))).alias("x")).select("kind", "x.*")
    wrong = (both.groupBy("kind", "what", "value").count().filter("count > 1")
             .groupBy("kind", "what").count().orderBy("kind", "what").collect())
    if wrong:
        raise ValueError("; ".join(f"{r['kind']}: {r['count']} x {r['what']}" for r in wrong))
    return replaced
