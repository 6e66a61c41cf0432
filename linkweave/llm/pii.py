"""Surrogates for personal data: keyed, type-consistent, collision-checked. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, skewed_join, text_key, written

_EDGE = r"(?<![\p{L}\p{N}])"
_END = r"(?![\p{L}\p{N}])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

#: Forms of address by the gender they tell (n: none).
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа"],
    "n": ["Dr", "Prof"],
}
#: Common given names by gender; with a second capitalised word behind they are a person's name.
GIVEN = {
    "m": ["James", "John", "Robert", "Michael", "David", "William", "Thomas", "Peter", "Paul", "Daniel", "George", "Hans", "Karl", "Klaus", "Jürgen",
          "Stefan", "Wolfgang", "Jean", "Pierre", "Michel", "Louis", "Jacques", "José", "Juan", "Carlos", "Luis", "Miguel", "Pedro", "Иван", "Сергей", "Дмитрий", "Алексей"],
    "f": ["Mary", "Anna", "Elizabeth", "Jennifer", "Linda", "Susan", "Sarah", "Karen", "Lisa", "Emma", "Alice", "Julia", "Maria", "Petra", "Sabine", "Monika", "Ursula",
          "Marie", "Sophie", "Claire", "Julie", "Isabelle", "María", "Carmen", "Isabel", "Lucía", "Елена", "Мария", "Ольга", "Наталья"],
}
#: Common Chinese surnames, and the forms of address that follow a name.
_SURNAMES = "王李张刘陈杨黄赵吴周徐孙马朱胡郭何高林罗"
_AFTER = "先生|女士|小姐"


def _any(words: dict[str, list[str]]) -> str:
    return "(?:" + "|".join(sorted((w for some in words.values() for w in some), key=len, reverse=True)) + ")"


_WORD = r"\p{Lu}[\p{L}'’\-]+"
_CALLED = rf"(?=\p{{Lu}})(?:{_any(TITLES)}\.?|{_any(GIVEN)}) "

#: Detectors in order of precedence; none matches the empty string. With each, what any of its matches holds,
#: for a plain scan that spares most texts the full patterns.
_DETECT = {
    "email": (r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)+", "@"),
    "secret": (_EDGE + r"(?:(?=[a-fA-F]*\d)[0-9a-fA-F]{32,}|AKIA[0-9A-Z]{16}|gh[opsu]_[A-Za-z0-9]{36})" + _END, r"[0-9]|AKIA|gh[opsu]_"),
    "iban": (_EDGE + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?" + _END, "[0-9]"),
    "ip": (r"(?<![\p{L}\p{N}.])" + _OCTET + r"(?:\." + _OCTET + r"){3}(?!\.?\d|\p{L})", "[0-9]"),
    "ssn": (_EDGE + r"\d{3}-\d{2}-\d{4}" + _END, "[0-9]"),
    "card": (_EDGE + r"(?:(?:\d{4}[ \-]){3}\d{4}|\d{13,19})" + _END, "[0-9]"),
    "phone": (r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}(?:[ .\-]?\(?\d{2,4}\)?){2,4}|\(?\d{3}\)?[ .\-]\d{3}[ .\-]\d{4})" + _END, "[0-9]"),
    "name": (f"{_EDGE}{_CALLED}{_WORD}(?: {_WORD}){{0,2}}|[{_SURNAMES}]\\p{{IsHan}}{{1,2}}(?={_AFTER})", f"{_CALLED}\\p{{Lu}}|{_AFTER}"),
}
DETECTORS = {kind: pattern for kind, (pattern, _) in _DETECT.items()}
PATTERN = "|".join(f"(?:{p})" for p in DETECTORS.values())
HINT = "|".join(dict.fromkeys(hint for _, hint in _DETECT.values()))

#: Syllables that surrogate names are built from, by script and role.
_SYLLABLES = {
    "latin": (["Al", "Bel", "Cor", "Dan", "El", "Fer", "Gil", "Hal", "Is", "Jor", "Kar", "Lor", "Mar", "Nor", "Or", "Per", "Ros", "Sal", "Tor", "Val"],
              ["a", "e", "i", "o", "an", "en", "in", "or", "ad", "el", "im", "os", "ur", "il", "ar", "em"],
              {"f": ["ina", "ella", "ora", "anne", "issa", "etta"], "m": ["ard", "us", "ik", "old", "win", "bert"], "n": ["y", "is", "ey", "en", "on", "ley"],
               "family": ["man", "berg", "ton", "field", "ez", "ier", "feld", "wick", "dale", "roy"]}),
    "cyrillic": (["Ал", "Бор", "Вал", "Гор", "Дар", "Ел", "Жар", "Зор", "Ив", "Кал", "Лад", "Мир", "Ник", "Ол", "Пав", "Рад", "Сав", "Тим", "Фед", "Юл"],
                 ["а", "е", "и", "о", "ан", "ен", "ин", "ор"],
                 {"f": ["ина", "ена", "ана", "ия"], "m": ["ор", "ан", "ей", "слав"], "n": ["я", "и", "ень", "ис"], "family": ["енко", "ский", "ов", "ин", "ук", "ич"]}),
    "greek": (["Αλ", "Βασ", "Γερ", "Δημ", "Ελ", "Ζαν", "Ηλ", "Θεο", "Καλ", "Λεω", "Μαρ", "Νικ"], ["α", "ε", "ι", "ο"],
              {"f": ["ίνα", "ία", "ώ"], "m": ["ος", "ης", "ας"], "n": ["ι", "ω", "υ"], "family": ["ίδης", "όπουλος", "άκης"]}),
}

#: Characters common in given names.
_HAN = "安博成德恩凡光海和佳金康丽明宁平清仁山思天文贤雅永远云泽正志"

#: Letters that replace letters of the same script, by the class of characters they stand for. The last two take what is left.
_ALPHABETS = {
    "[a-z]": "abcdefghijklmnopqrstuvwxyz",
    "[0-9]": "0123456789",
    r"\p{IsLatin}": "àáâãäåæçèéêëìíîïñòóôõöøùúûüýāăąćčđēęěğīłńňőœřśşšťūůűźżž",
    r"\p{IsCyrillic}": "абвгдежзийклмнопрстуфхцчшщыэюя",
    r"\p{IsGreek}": "αβγδεζηθικλμνοπρστυφχψω",
    r"\p{IsHan}": _HAN,
    r"\p{IsArabic}": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    r"\p{IsHebrew}": "אבגדהוזחטיכלמנסעפצקרשת",
    r"\p{IsDevanagari}": "कखगघचछजझटठडढणतथदधनपफबभमयरलवशषसह",
    r"\p{IsThai}": "กขคงจฉชซญดตถทธนบปผพฟมยรลวสห",
    r"\p{IsHangul}": "가나다라마바사아자차카타파하거너더러머버서어저처커터퍼허",
    r"\p{IsHiragana}": "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめも",
    r"\p{IsKatakana}": "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモ",
    r"\p{L}": "abcdefghijklmnopqrstuvwxyz",
    r"\p{N}": "0123456789",
}

#: Country codes of telephone numbers by their length (fixed values: zones 1 and 7, the two-digit codes, three digits else).
_COUNTRY = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})|^0"


@dataclass(frozen=True)
class SurrogateOptions:
    """``key`` decides all replacements; ``rounds`` bounds the attempts against collisions (from the tenth on
    candidates get longer, so formats don't run out)."""

    key: str = "linkweave-surrogate-key"
    rounds: int = 40


def _pick(seed: Column, at: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(seed, at), F.lit(n)).cast("int")


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _mapped(text: Column, seed: Column, hexadecimal: Column) -> Column:
    """Each lower-case letter or digit replaced by another one of its script, never by itself; all else stays."""

    def known(c: Column) -> Column:
        letters = F.when(hexadecimal & c.rlike("^[a-f]$"), "abcdef")
        for kind, some in _ALPHABETS.items():
            letters = letters.when(c.rlike(f"^{kind}$"), some)
        return F.struct(c.alias("c"), letters.alias("letters"))

    def other(x: Column, i: Column) -> Column:
        at, n, pick = F.instr(x["letters"], x["c"]), F.length(x["letters"]), F.xxhash64(seed, i)
        place = F.when(at > 0, F.pmod(at + F.pmod(pick, n - 1), n)).otherwise(F.pmod(pick, n))
        return F.coalesce(F.substring(x["letters"], place.cast("int") + 1, F.lit(1)), x["c"])

    return F.array_join(F.transform(F.transform(_chars(text), known), other), "")


def _more(seed: Column, attempt: int) -> Column:
    """Digits appended from the tenth attempt on, one more each time."""
    n = max(0, attempt - 9)
    return F.array_join(F.array(*[_pick(seed, F.lit(1000 + i), 10).cast("string") for i in range(n)]), "") if n else F.lit("")


def _luhn(digits: Column, shift: int) -> Column:
    """Luhn sum; ``shift`` 0: the last digit counts once, 1: twice."""
    places = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")))

    def add(total: Column, x: Column) -> Column:
        twice = (x["i"] + shift) % 2 == 1
        return total + F.when(twice, x["d"] * 2 - F.when(x["d"] > 4, 9).otherwise(0)).otherwise(x["d"])

    return F.aggregate(places, F.lit(0), add)


def _card(norm: Column, body: Column, seed: Column) -> Column:
    """``body`` with a last digit that makes it valid by Luhn exactly if the original is."""
    check = F.pmod(F.lit(10) - F.pmod(_luhn(body, 1), F.lit(10)), F.lit(10))
    wrong = F.pmod(check + 1 + _pick(seed, F.lit(99), 9), F.lit(10))
    return F.concat(body, F.when(_luhn(norm, 0) % 10 == 0, check).otherwise(wrong).cast("string"))


def _mod97(text: Column) -> Column:
    """Remainder by 97 of lower-case letters and digits read as one number, a as 10 to z as 35."""

    def add(total: Column, c: Column) -> Column:
        return F.when(c.rlike("^[0-9]$"), (total * 10 + F.ascii(c) - 48) % 97).otherwise((total * 100 + F.ascii(c) - 87) % 97).cast("int")

    return F.aggregate(_chars(text), F.lit(0), add)


def _iban(norm: Column, account: Column, seed: Column) -> Column:
    """The same country, another account, check digits right exactly if the original's are."""
    country = F.substring(norm, 1, 2)
    right = F.lit(98) - _mod97(F.concat(account, country, F.lit("00")))
    valid = _mod97(F.concat(F.substring(norm, F.lit(5), F.length(norm)), F.substring(norm, 1, 4))) == 1
    wrong = F.pmod(right - 2 + 1 + _pick(seed, F.lit(99), 96), F.lit(97)) + 2
    return F.concat(country, F.lpad(F.when(valid, right).otherwise(wrong).cast("string"), 2, "0"), account)


def _ip(norm: Column, seed: Column, attempt: int) -> Column:
    """Octets of the same number of digits; from the fourth attempt on any octets."""

    def octet(c: Column, i: Column) -> Column:
        free = 1 + _pick(seed, i, 254)
        if attempt >= 4:
            return free.cast("string")
        n = F.length(c)
        return F.when(n == 1, 1 + _pick(seed, i, 9)).when(n == 2, 10 + _pick(seed, i, 90)).otherwise(100 + _pick(seed, i, 155)).cast("string")

    return F.array_join(F.transform(F.split(norm, r"\."), octet), ".")


def _name(role: Column, gender: Column, norm: Column, mapped: Column, seed: Column, attempt: int) -> Column:
    """A name of the script, role and gender; more attempts add syllables, so names never run out."""

    def some(options: list[str], at: int) -> Column:
        return F.element_at(F.array(*[F.lit(x) for x in options]), _pick(seed, F.lit(at), len(options)) + 1)

    def build(script: str) -> Column:
        first, middle, ends = _SYLLABLES[script]
        end = F.when(role == "family", some(ends["family"], 2)).when(gender == "f", some(ends["f"], 2)).when(gender == "m", some(ends["m"], 2)).otherwise(some(ends["n"], 2))
        return F.concat(some(first, 0), *[some(middle, 3 + i) for i in range(1 + attempt // 2)], end)

    longer = [some(list(_HAN), 50 + i) for i in range(max(0, attempt - 3))]
    return (
        F.when(norm.rlike(r"\p{IsHan}"), F.concat(some(list(_SURNAMES), 0), mapped, *longer)).when(norm.rlike(r"\p{IsCyrillic}"), build("cyrillic"))
        .when(norm.rlike(r"\p{IsGreek}"), build("greek")).when(norm.rlike(r"\p{IsLatin}"), build("latin"))
        .otherwise(F.concat(mapped, *[F.substring(mapped, 1, 1)] * max(0, attempt - 3)))
    )


def _candidates(entities: DataFrame, options: SurrogateOptions, attempt: int) -> DataFrame:
    """``entities`` (kind, norm, role, gender) with the candidate ``sur`` of this attempt, in normal form.

    A candidate keeps what tells its kind: the top domain, a card's first digit, a country or its telephone
    code, an issuer's prefix. The rest is mapped character by character.
    """
    kind, norm, seed = F.col("kind"), F.col("norm"), F.col("seed")
    keyed = lambda *parts: F.sha2(F.concat_ws("\u0001", F.lit(options.key), *parts), 256)
    prefix = (
        F.when(kind == "card", F.substring(norm, 1, 1)).when(kind == "phone", F.regexp_extract(norm, _COUNTRY, 0))
        .when(kind == "secret", F.regexp_extract(norm, "^(?:akia(?=[0-9a-z]{16}$)|gh[opsu](?=[0-9a-z]{36}$))", 0)).otherwise("")
    )
    body = (
        F.when(kind == "email", F.element_at(F.split(norm, "@"), 1)).when(kind == "card", F.substring(norm, F.lit(2), F.length(norm) - 2))
        .when(kind == "iban", F.substring(norm, F.lit(5), F.length(norm))).when((kind == "name") & norm.rlike(r"\p{IsHan}"), F.substring(norm, F.lit(2), F.length(norm)))
        .otherwise(F.substring(norm, F.length("prefix") + 1, F.length(norm)))
    )
    domain = F.when(kind == "email", F.element_at(F.split(norm, "@"), -1))
    rows = entities.withColumn("seed", keyed(kind, norm, F.lit(str(attempt)))).withColumn("prefix", prefix).withColumn("body", body).withColumn("domain", domain)
    rows = rows.withColumn("mapped", _mapped(F.col("body"), seed, (kind == "secret") & norm.rlike("^[0-9a-f]+$")))
    top = F.regexp_extract("domain", r"\.[^.]*$", 0)
    # a domain maps to one surrogate domain whatever stands before the @
    host = F.concat(_mapped(F.substring(F.col("domain"), F.lit(1), F.length("domain") - F.length(top)), keyed(F.lit("domain"), F.col("domain")), F.lit(False)), top)
    tail = F.substring(seed, 1, 2 * (attempt - 5)) if attempt > 5 else F.lit("")
    mapped, longer = F.col("mapped"), _more(seed, attempt)
    sur = (
        F.when(kind == "email", F.concat(mapped, tail, F.lit("@"), host))
        .when(kind == "ip", _ip(norm, seed, attempt))
        .when(kind == "card", _card(norm, F.concat("prefix", mapped, longer), seed))
        .when(kind == "iban", _iban(norm, F.concat(mapped, longer), seed))
        .when(kind == "name", _name(F.col("role"), F.col("gender"), norm, mapped, seed, attempt))
        .when(kind == "secret", F.concat("prefix", mapped))
        .otherwise(F.concat("prefix", mapped, longer))
    )
    return rows.withColumn("sur", sur).drop("seed", "prefix", "body", "domain", "mapped")


def _laid_out(surface: Column, sur: Column, kind: Column) -> Column:
    """The surrogate in the surface's format: separators and letter case as found."""
    marks = r"[^0-9A-Za-z]"
    sur = F.when(kind == "phone", F.regexp_replace(sur, "^[+]", "")).otherwise(sur)
    letters = F.filter(F.split(surface, ""), lambda c: c != "")

    def spread(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substring(surface, F.lit(1), i), marks, ""))
        new = F.substring(sur, before + 1, F.lit(1))
        return F.when(c.rlike(marks), c).otherwise(F.when(c.rlike("[A-Z]"), F.upper(new)).otherwise(new))

    def cased(c: Column, i: Column) -> Column:
        new = F.substring(sur, i + 1, F.lit(1))
        return F.when(c != F.lower(c), F.upper(new)).otherwise(new)

    cut = F.concat(F.array_join(F.transform(letters, cased), ""), F.substring(sur, F.length(surface) + 1, F.length(sur)))
    return (
        F.when(kind.isin("phone", "card", "ssn", "iban", "secret"), spread_all(letters, spread, sur, surface))
        .when(kind == "email", cut)
        .when((kind == "name") & (surface == F.upper(surface)) & (F.length(surface) > 1), F.upper(sur))
        .otherwise(sur)
    )


def spread_all(letters: Column, spread, sur: Column, surface: Column) -> Column:
    """All marks of the surface with the surrogate's letters, and what the surrogate has beyond them."""
    used = F.length(F.regexp_replace(surface, r"[^0-9A-Za-z]", ""))
    return F.concat(F.array_join(F.transform(letters, spread), ""), F.substring(sur, used + 1, F.length(sur)))


def find_entities(texts: DataFrame) -> DataFrame:
    """(text_key, matches) of the distinct texts with a match."""
    matches = F.regexp_extract_all("text", F.lit(f"({PATTERN})"), F.lit(0))
    found = texts.filter(F.col("text").rlike(HINT)).select(text_key(F.col("text")).alias("text_key"), matches.alias("matches"))
    return found.filter(F.size("matches") > 0).dropDuplicates(["text_key"])


def _pieces(found: DataFrame) -> DataFrame:
    """One row per replaced piece: a whole match, or each word of a name; a form of address is kept."""
    surface = F.col("surface")
    kind = F.lit("name")
    for name in reversed([k for k in DETECTORS if k != "name"]):
        kind = F.when(surface.rlike(f"^(?:{DETECTORS[name]})$"), F.lit(name)).otherwise(kind)
    rows = found.select("text_key", F.posexplode("matches").alias("i", "surface")).withColumn("kind", kind)
    words = F.split(surface, " ")
    first = F.regexp_replace(F.element_at(words, 1), r"\.$", "")
    titled = first.isin([t for some in TITLES.values() for t in some])
    told = F.when(first.isin(TITLES["f"]), "f").when(first.isin(TITLES["m"]), "m").otherwise("n")

    def word(w: Column, j: Column) -> Column:
        own = F.when(w.isin(GIVEN["m"]), "m").when(w.isin(GIVEN["f"]), "f").otherwise("n")
        role = F.when((j == 0) & titled, "keep").when(w.isin([g for some in GIVEN.values() for g in some]), "given")
        role = role.when(j == F.size(words) - 1, "family").otherwise("given")
        return F.struct(F.lit("name").alias("kind"), w.alias("surface"), role.alias("role"), F.when(told == "n", own).otherwise(told).alias("gender"))

    one = F.array(F.struct(F.col("kind").alias("kind"), surface.alias("surface"), F.lit("whole").alias("role"), F.lit("n").alias("gender")))
    rows = rows.select("text_key", "i", F.posexplode(F.when(F.col("kind") == "name", F.transform(words, word)).otherwise(one)).alias("j", "p"))
    rows = rows.select("text_key", "i", "j", "p.*")
    bare = F.lower(F.regexp_replace("surface", r"[^0-9A-Za-z]", ""))
    bare = F.when((F.col("kind") == "phone") & F.col("surface").startswith("+"), F.concat(F.lit("+"), bare)).otherwise(bare)
    norm = F.when(F.col("kind").isin("phone", "card", "ssn", "iban", "secret"), bare).otherwise(F.lower("surface"))
    return rows.withColumn("norm", norm).withColumn("entity", F.concat_ws("\u0001", "kind", "norm"))


def _entities(pieces: DataFrame) -> DataFrame:
    """One row per entity. A name is one entity whatever place it has in a full name: a given
    name if it ever stands as one. Its gender is the one that its mentions tell, none if they tell both."""
    told = lambda g: F.max((F.col("gender") == g).cast("int"))
    found = pieces.filter("role <> 'keep'").groupBy("entity", "kind", "norm").agg(
        F.max((F.col("role") == "given").cast("int")).alias("given"), told("m").alias("m"), told("f").alias("f")
    )
    role = F.when(F.col("given") == 1, "given").otherwise("family")
    gender = F.when(F.expr("m > f"), "m").when(F.expr("f > m"), "f").otherwise("n")
    return found.select("entity", "kind", "norm", role.alias("role"), gender.alias("gender"))


def assign(entities: DataFrame, options: SurrogateOptions) -> DataFrame:
    """(entity, sur) with distinct surrogates that are no entity of the corpus themselves.

    In each round every open entity gets a candidate; it is taken by the least entity that asks for it
    unless it is taken already or equals (in normal form) an entity found in the corpus. The others go
    on to the next round. Rounds end when none is open, mostly after one or two. Entity tables grow with
    the corpus, so they are joined by sort-merge at every size and never broadcast.
    """
    everything = written(entities.select("entity", "kind", "norm", "role", "gender"))
    real = everything.select(F.col("kind").alias("rk"), F.col("norm").alias("rn")).hint("merge")
    open_, taken = everything, None
    for attempt in range(options.rounds):
        candidates = _candidates(open_, options, attempt)
        free = candidates.join(real, (F.col("kind") == F.col("rk")) & (F.lower("sur") == F.col("rn")), "left_anti")
        if taken is not None:
            gone = taken.select(F.col("kind").alias("tk"), F.col("sur").alias("ts")).hint("merge")
            free = free.join(gone, (F.col("kind") == F.col("tk")) & (F.col("sur") == F.col("ts")), "left_anti")
        won = written(free.groupBy("kind", "sur").agg(F.min("entity").alias("entity")))
        taken = won if taken is None else taken.unionByName(won)
        open_ = written(open_.join(won.select("entity").hint("merge"), "entity", "left_anti"))
        if open_.isEmpty():
            return taken.select("entity", "sur")
    raise RuntimeError("a format has too few values for distinct surrogates")


def surrogates(docs: DataFrame, options: SurrogateOptions = SurrogateOptions()) -> DataFrame:
    """Every row of ``docs`` as doc_id, text (with surrogates), n_entities, changed.

    Detected are e-mail addresses, keys and hexadecimal secrets, IBANs, IPv4 addresses, social security
    and card numbers, phone numbers, and names: after a form of address, or a common given name with a capitalised
    word behind it. Further mentions of a detected name in the same text are replaced as well, wherever they stand;
    ``n_entities`` does not count these. The same entity (whatever its case or separators) gets the same surrogate in
    all documents, different ones get different ones. Null text stays null, empty texts and those without a match
    stay as they are; repeated rows are rows of their own; an empty table gives no rows; further columns are ignored.
    """
    pieces = written(_pieces(find_entities(docs.select("text"))))
    chosen = assign(_entities(pieces), options)
    out = F.when(F.col("role") == "keep", F.col("surface")).otherwise(_laid_out(F.col("surface"), F.col("sur"), F.col("kind")))
    entry = F.struct("i", "j", out.alias("out"), "surface", ((F.col("kind") == "name") & (F.col("role") != "keep")).alias("name"))
    met = skewed_join(pieces, chosen, "entity", "left")
    lists = met.groupBy("text_key").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    name = F.transform(F.filter("entries", lambda e: e["name"]), lambda e: F.struct(e["surface"].alias("surface"), e["out"].alias("out")))
    lists = written(lists.withColumn("names", F.array_distinct(name)))
    forget(pieces)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    may = F.col("text").isNotNull() & F.col("text").rlike(HINT)
    # texts that can't hold an entity move nowhere; the others meet their entries by sort-merge, where copies are split
    touched = skewed_join(rows.filter(may).withColumn("text_key", text_key(F.col("text"))), lists, "text_key", "left")
    gaps = F.transform(F.split("text", PATTERN, -1), lambda g: F.aggregate("names", g, _again))
    found = F.col("entries").isNotNull()
    # used twice, so it stays a column and is made once a text, not once an entry
    touched = touched.withColumn("gaps", F.when(found, gaps))
    new = F.concat(
        F.array_join(F.transform("entries", lambda e: F.concat(F.when(e["j"] == 0, F.get("gaps", e["i"])).otherwise(F.lit(" ")), e["out"])), ""),
        F.element_at("gaps", -1),
    )
    count = F.size(F.filter("entries", lambda e: e["j"] == 0))
    touched = touched.select("doc_id", F.when(found, new).otherwise(F.col("text")).alias("text"), F.when(found, count).otherwise(F.lit(0)).alias("n_entities"), found.alias("changed"))
    return touched.union(rows.filter(~F.coalesce(may, F.lit(False))).select("doc_id", "text", F.lit(0), F.lit(False)))


def _again(text: Column, name: Column) -> Column:
    """``text`` with every whole-word mention of a name replaced: as it was found, and in capitals."""
    for change in (lambda c: c, F.upper):
        pattern = F.concat(F.lit(_EDGE + r"\Q"), change(name["surface"]), F.lit(r"\E" + _END))
        text = F.regexp_replace(text, pattern, change(name["out"]))
    return text
