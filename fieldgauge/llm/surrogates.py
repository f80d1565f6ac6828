"""Surrogates for personal data, in DataFrame functions alone.

Entities are found by one pattern. Each gets a replacement derived from a key, its type and its
normalised form, so that all mentions of one entity agree in the whole corpus; it keeps the type, the
script and case of every letter, the format of every number (a card number stays valid), and of a name
the gender of its title.

Distinct entities, not texts, are shuffled to check that no two share a surrogate and that none is an
entity of the corpus itself. The losers of a clash take their next draw until there is none; their few
attempt numbers are all that is looked up when texts are rewritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm.staging import cut_lineage, small_side, without

# Titles that name a person, by gender.
MALE_TITLES = ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita", "Sra")

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# A name: capitals and apostrophes (O'Brien, McDonald) and hyphened parts inside, initials before it.
_NAME = (
    r"(?:\p{Lu}\. ?){0,3}(?:\p{Lu}['’])?\p{Lu}[\p{Ll}\p{M}][\p{L}\p{M}]{0,60}"
    r"(?:['’]\p{Lu}[\p{L}\p{M}]{0,60}|-\p{L}[\p{L}\p{M}]{0,60}){0,4}(?![\p{L}\p{M}])"
)
_IP = rf"(?<![\p{{L}}\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[\p{{L}}\p{{N}}])"
_OTHER = rf"{_IP}|\d{{3}}-\d{{2,3}}-\d{{4}}(?![\p{{L}}\p{{N}}-])"
#: Patterns by type, in the order in which they are tried at one place. No match spans white space
#: other than the blanks written here, and every repetition is bounded.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}])[\p{L}\p{N}][\p{L}\p{N}._+-]{0,254}@(?:[\p{L}\p{N}-]{1,63}\.){1,8}\p{L}{2,24}",
    "secret": r"(?i:token|secret|password|api_?key)(?: ?[=:] ?)[\"'][\x21\x23-\x26\x28-\x7E]{8,4096}[\"']",
    "phone": r"(?<![\p{L}\p{N}+.])\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,4}(?![\p{L}\p{N}])"
             r"|(?<![\p{L}\p{N}+.(])\(\d{3}\) ?\d{3}[.-]\d{4}(?![\p{L}\p{N}])"
             r"|(?<![\p{L}\p{N}+.-])\d{3}-\d{3}-\d{4}(?![\p{L}\p{N}-])",
    "ssn": r"(?<![\p{L}\p{N}.-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    # A whole run of groups of digits, short of another type after a blank: cards are looked for within it.
    "card": rf"(?<![\p{{L}}\p{{N}}.-])(?=\d(?:[ -]?\d){{12}})\d{{1,19}}(?:(?:-| (?!{_OTHER}))\d{{1,19}}){{0,200}}(?![\p{{L}}\p{{N}}])",
    "ip": _IP,
    "person": rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(MALE_TITLES + FEMALE_TITLES)})\.? {_NAME}(?: {_NAME}){{0,2}}",
}
# Digits a card has, and how those of that many begin.
CARD_STARTS = {16: "(?:[3-6]|2[2-7])", 15: "3[47]", 14: "3[0689]", 13: "4", 19: "[46]"}
#: Within a run of digits: groups that make up a card by their number of digits, from any group on, and any
#: 13 to 19 digits one after the other.
CARDS_WITHIN = tuple(
    (rf"(?<!\d)(?={start})(?=(\d(?:[ -]?\d){{{n - 1}}})(?!\d))", 1) for n, start in CARD_STARTS.items()
) + ((r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)", 0),)
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every match contains: a text without it is not searched.
HINT = rf"[0-9@]|(?:{'|'.join(MALE_TITLES + FEMALE_TITLES)})\.? \p{{Lu}}|(?i:token|secret|password|key) ?[=:]"

# Alphabets of the scripts whose letters are replaced by others of the same script.
ALPHABETS = (
    ("[a-z]", "abcdefghijklmnopqrstuvwxyz"),
    ("[ß-öø-ÿ]", "àâäçèéêëîïñôöùûü"),
    ("[α-ω]", "αβγδεζηθικλμνξοπρστυφχψω"),
    ("[а-я]", "абвгдежзийклмнопрстуфхцчшщъыьэюя"),
    (r"\p{IsLatin}", "ăąćčďđęěğįłńňőřśşšťůűźżž"),
    (r"\p{IsCyrillic}", "ђєіїјљњћўџґ"),
    (r"\p{IsGreek}", "άέήίόύώ"),
    (r"\p{IsHan}", "山川水火木金土日月田石竹花草風雨雪雲星海"),
    (r"\p{IsHiragana}", "あいうえおかきくけこさしすせそたちつてと"),
    (r"\p{IsKatakana}", "アイウエオカキクケコサシスセソタチツテト"),
    (r"\p{IsHangul}", "가나다라마바사아자차카타파하고노도로모보"),
    (r"\p{IsArabic}", "ابتجحدرسصطعفقكلمنهوي"),
    (r"\p{IsHebrew}", "אבגדהוזחטיכלמנסעפצקר"),
    (r"\p{IsDevanagari}", "कखगघचछजझटठडढतथदधनपफब"),
    (r"\p{IsThai}", "กขคงจฉชซญดตถทธนบปผพฟ"),
    # Letters of any other script, as a last resort.
    (r"\p{L}", "abcdefghijklmnopqrstuvwxyz"),
)
# Vowels, consonants and endings that names are made of, by script.
NAME_PARTS = (
    ("[а-я]", "аеиоу", "бвгдзклмнпрст", ("ан", "ор"), ("а", "ина")),
    ("[α-ω]", "αειο", "βγδκλμνπρτ", ("ος", "ης"), ("α", "η")),
    ("", "aeiou", "bdfgklmnprstv", ("an", "or"), ("a", "ine")),
)
ATTEMPTS = 30


#: From this attempt on a surrogate gets one letter or digit more with each, as its own length is used up.
WIDER_FROM = 3


def _wider(digest: Column, attempt: Column, letters: str = "bdfgklmnprstvaei") -> Column:
    """Further letters (or digits) of an entity that drew often; none for the first draws."""
    more = F.least(F.greatest(attempt - (WIDER_FROM - 1), F.lit(0)), F.lit(100))
    return F.translate(F.substr(digest, F.lit(20), more), "0123456789abcdef", letters)


def _hex(digest: Column, i: Column | int, below: int) -> Column:
    """The ``i``-th number below ``below`` of a 512-bit digest."""
    at = (F.lit(i) if isinstance(i, int) else i) * 2 % 124 + 1
    return (F.conv(F.substr(digest, at, F.lit(4)), 16, 10).cast("int") % below).cast("int")


def _pick(letters: str, number: Column) -> Column:
    return F.substr(F.lit(letters), number + 1, F.lit(1))


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def luhn_sum(digits: Column) -> Column:
    """Sum of the Luhn check, whose last digit is 0 for a valid number."""
    backwards = F.split(F.reverse(digits), "")

    def term(c, i):
        n = c.cast("int")
        return F.when(i % 2 == 0, n).otherwise(n * 2 - F.when(n > 4, 9).otherwise(0))

    return F.aggregate(F.transform(backwards, term), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))


def is_card(surface: Column) -> Column:
    digits = _digits(surface)
    return digits.rlike(r"^(?:[3-6]|2[2-7])\d{11,18}$") & F.length(digits).between(13, 19) & (luhn_sum(digits) % 10 == 0)


def type_of(surface: Column) -> Column:
    """Type of a match; NULL for a number that is not a card's as a whole."""
    tests = {
        "secret": surface.rlike(f"^(?:{PATTERNS['secret']})$"),
        "email": surface.contains("@"),
        "person": surface.rlike(r"^\p{L}"),
        "ip": surface.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"),
        "phone": surface.rlike(rf"^(?:{PATTERNS['phone']})$"),
        "ssn": surface.rlike(r"^\d{3}-\d{2}-\d{4}$"),
    }
    found = F.when(F.lit(False), F.lit(""))
    for name, test in tests.items():
        found = found.when(test, F.lit(name))
    return found.when(is_card(surface), F.lit("card"))


def _gender(surface: Column) -> Column:
    return F.when(surface.rlike(rf"^(?:{'|'.join(FEMALE_TITLES)})\.? "), F.lit("f")).otherwise(F.lit("m"))


def _title(surface: Column) -> Column:
    return F.regexp_extract(surface, r"^\S+ ", 0)


def _names(surface: Column) -> Column:
    return F.regexp_replace(surface, r"^\S+ ", "")


def normal_form(kind: Column, surface: Column) -> Column:
    """What mentions of one entity have in common."""
    return (
        F.when(kind == "email", F.lower(surface))
        .when(kind.isin("phone", "ssn", "card"), _digits(surface))
        .when(kind == "person", F.concat(_gender(surface), F.lit(" "), F.lower(_names(surface))))
        .when(kind == "secret", F.regexp_extract(surface, "[\"'](.*)[\"']$", 1))
        .otherwise(surface)
    )


def _digest(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("\u0001", F.lit(key), *parts).cast("binary"), 512)


def _scrambled(text: Column, digest: Column) -> Column:
    """Every letter and digit replaced by one of its own kind and case; anything else stays."""

    def swapped(c, low, number):
        new = F.when(c.rlike(r"\p{N}"), (number % 10).cast("string"))
        for pattern, letters in ALPHABETS:
            new = new.when(low.rlike(f"^{pattern}$"), _pick(letters, number % len(letters)))
        return new.otherwise(c)

    def swap(c, i):
        parts = F.struct(c.alias("c"), F.lower(c).alias("low"), _hex(digest, i, 9_240).alias("n"))
        return _let(parts, lambda p: _let(
            swapped(p["c"], p["low"], p["n"]), lambda new: F.when(p["c"] != p["low"], F.upper(new)).otherwise(new)
        ))

    hexadecimal = F.array_join(F.transform(F.split(text, ""), lambda _, i: F.lower(F.hex(_hex(digest, i, 16)))), "")
    return F.when(text.rlike("^[0-9a-f]{16,}$"), hexadecimal).otherwise(F.array_join(F.transform(F.split(text, ""), swap), ""))


def _new_digits(digits: Column, digest: Column) -> Column:
    """As many digits, the first one kept."""
    return F.array_join(
        F.transform(F.split(digits, ""), lambda c, i: F.when(i == 0, c).otherwise(_hex(digest, i, 10).cast("string"))), ""
    )


def _valid_card(digits: Column) -> Column:
    """The number with its last digit set so that it passes the Luhn check."""
    return _let(
        F.substr(digits, F.lit(1), F.length(digits) - 1),
        lambda head: F.concat(head, ((10 - luhn_sum(F.concat(head, F.lit("0"))) % 10) % 10).cast("string")),
    )


def _new_name(word: Column, digest: Column, gender: Column | None) -> Column:
    """A word of syllables in the script of ``word``; with a gender it ends accordingly."""
    made = None
    for pattern, vowels, consonants, male, female in reversed(NAME_PARTS):
        syllables = [
            F.concat(_pick(consonants, _hex(digest, 2 * i, len(consonants))), _pick(vowels, _hex(digest, 2 * i + 1, len(vowels))))
            for i in range(3 if gender is not None else 4)
        ]
        if gender is None:
            tail = _pick(consonants, _hex(digest, 9, len(consonants)))
        else:
            last = _pick(consonants, _hex(digest, 9, len(consonants)))
            first, second = (F.when(gender == "f", F.lit(f)).otherwise(F.lit(m)) for m, f in zip(male, female))
            tail = F.concat(last, F.when(_hex(digest, 10, 2) == 0, first).otherwise(second))
        word_here = F.initcap(F.concat(*syllables, tail))
        made = word_here if made is None else F.when(word.rlike(pattern), word_here).otherwise(made)
    return made


def core(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """The normalised surrogate of an entity."""
    tries = attempt.cast("string")
    return _let(_digest(key, kind, norm, tries), lambda digest: _core(key, kind, norm, attempt, tries, digest))


def _core(key: str, kind: Column, norm: Column, attempt: Column, tries: Column, digest: Column) -> Column:
    local, domain = F.regexp_extract(norm, "^([^@]*)@", 1), F.regexp_extract(norm, r"@(.*)\.[^.]*$", 1)
    top = F.regexp_extract(norm, r"\.[^.]*$", 0)
    # Addresses of one domain stay together.
    email = F.concat(
        _scrambled(local, digest), _wider(digest, attempt), F.lit("@"),
        _let(_digest(key, F.lit("domain"), domain), lambda own: _scrambled(domain, own)), top,
    )
    ip = F.array_join(F.transform(F.split(norm, r"\."), lambda _, i: (_hex(digest, i, 254) + 1).cast("string")), ".")
    number = F.concat(_new_digits(norm, digest), _wider(digest, attempt, "0123456789012345"))
    words = F.split(F.substr(norm, F.lit(3)), " ")

    def name(word, i):
        # A family keeps its surrogate whoever is named with it; the given name takes the attempts.
        count, gender = F.size(words), F.substr(norm, F.lit(1), F.lit(1))
        family = F.when(count == 1, tries).otherwise(F.lit("0"))
        return F.when(
            i == count - 1,
            _let(_digest(key, F.lit("family"), word, family), lambda own: _new_name(word, own, None)),
        ).otherwise(_let(_digest(key, F.lit("given"), gender, word, tries), lambda own: _new_name(word, own, gender)))

    person = F.concat(
        F.substr(norm, F.lit(1), F.lit(2)), F.lower(F.array_join(F.transform(words, name), " ")), _wider(digest, attempt)
    )
    return (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", _valid_card(number))
        .when(kind.isin("phone", "ssn"), number).when(kind == "person", person)
        .when(kind == "secret", F.concat(_scrambled(norm, digest), _wider(digest, attempt)))
    )


def rendered(kind: Column, surface: Column, made: Column) -> Column:
    """The surrogate in the format of a mention: its separators, its capitals, its title."""
    number = F.aggregate(
        F.split(surface, ""),
        F.struct(F.lit("").alias("text"), F.lit(1).alias("at")),
        lambda a, c: F.when(
            c.rlike("[0-9]"),
            F.struct(F.concat(a["text"], F.substr(made, a["at"], F.lit(1))).alias("text"), (a["at"] + 1).alias("at")),
        ).otherwise(F.struct(F.concat(a["text"], c).alias("text"), a["at"].alias("at"))),
        lambda a: F.concat(a["text"], F.substr(made, a["at"], F.length(made))),
    )
    cased = F.array_join(
        F.zip_with(F.split(surface, ""), F.split(made, ""), lambda s, m: F.when(s != F.lower(s), F.upper(m)).otherwise(m)), ""
    )
    value = normal_form(F.lit("secret"), surface)
    return (
        F.when(kind.isin("phone", "ssn", "card"), number).when(kind == "email", cased)
        .when(kind == "person", F.concat(_title(surface), F.initcap(F.substr(made, F.lit(3)))))
        .when(kind == "secret", F.replace(surface, value, made)).otherwise(made)
    )


def matches(text: Column) -> Column:
    """All matches in a text, in order; none if nothing in it hints at one."""
    none = F.array().cast("array<string>")
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(none)


def _is_run(surface: Column) -> Column:
    """Whether a match is digits that are no entity as a whole."""
    return surface.rlike(r"^\d[\d -]*$") & type_of(surface).isNull()


def _card_pattern(run: Column) -> Column:
    """A pattern of the valid cards within a run of digits, longer ones first; it matches nothing if there is none."""
    windows = F.concat(*[F.regexp_extract_all(run, F.lit(p), F.lit(group)) for p, group in CARDS_WITHIN])
    valid = F.array_sort(
        F.filter(F.array_distinct(windows), is_card), lambda a, b: F.length(b) - F.length(a)
    )
    return _let(valid, lambda v: F.when(F.size(v) > 0, F.concat(F.lit(r"(?<!\d)(?:"), F.array_join(v, "|"), F.lit(r")(?!\d)"))).otherwise("(?!)"))


def _within(found: Column) -> Column:
    """Matches, with runs of digits replaced by the cards in them."""
    def cards(run):
        return _let(_card_pattern(run), lambda p: F.regexp_extract_all(run, p, F.lit(0)))

    return F.flatten(F.transform(found, lambda s: F.when(_is_run(s), cards(s)).otherwise(F.array(s))))


def mentions(text: Column) -> Column:
    """All mentions of entities in a text, in order, and what else matches."""
    return _within(matches(text))


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct ``(kind, norm)`` of the corpus."""
    surface = docs.select(F.explode(F.array_distinct(mentions(F.col(text)))).alias("surface")).distinct()
    typed = surface.withColumn("kind", type_of(F.col("surface"))).filter("kind IS NOT NULL")
    return typed.select("kind", normal_form(F.col("kind"), F.col("surface")).alias("norm")).distinct()


def settle(found: DataFrame, key: str, attempts: int = ATTEMPTS) -> DataFrame:
    """``(kind, norm, attempt, made)``: distinct surrogates, none of them an entity of the corpus.

    Of entities that clash the least keeps its draw; the rest draw again, from the third time on with one
    letter or digit more each time, so that a space that is used up widens. Only addresses of machines
    (``ip``) cannot widen; what still clashes after ``attempts`` rounds keeps its last draw.
    """
    found = cut_lineage(found)
    settled = cut_lineage(found.withColumn("attempt", F.lit(0)).withColumn("made", core(key, F.col("kind"), F.col("norm"), F.lit(0))))
    for _ in range(attempts):
        taken = settled.groupBy("kind", "made").agg(F.min(F.struct("attempt", "norm")).alias("first"), F.count("*").alias("n"))
        real = found.select("kind", F.col("norm").alias("made"), F.lit(True).alias("real"))
        clashes = cut_lineage(
            taken.join(real, ["kind", "made"], "left").filter("n > 1 OR real").select("kind", "made", "first", "real")
        )
        if clashes.isEmpty():
            return settled
        again = settled.join(small_side(clashes), ["kind", "made"], "left").withColumn(
            "attempt",
            F.col("attempt") + F.when(F.col("real") | (F.col("first.norm") != F.col("norm")), 1).otherwise(0),
        )
        settled = cut_lineage(
            again.select("kind", "norm", "attempt", core(key, F.col("kind"), F.col("norm"), F.col("attempt")).alias("made"))
        )
    return settled


def pseudonymise(docs: DataFrame, key: str = "surrogates", text: str = "text", attempts: int = ATTEMPTS) -> DataFrame:
    """Every row with the personal data in ``text`` replaced and ``n_replaced`` mentions counted.

    * Equal mentions get equal surrogates everywhere, different entities different ones.
    * Numbers that fail the card check are left alone, as is any text without a match. Of digits in groups
      that fail as a whole, those are replaced that are a valid card by themselves.
    * A NULL text stays NULL, an empty one empty, both with 0 replaced. Repeated rows are treated alike.
    * Texts are searched whole. They are not shuffled, unless so many entities clash that their
      attempts cannot be broadcast.
    * An input column named ``n_replaced`` is replaced.
    """
    kept = without(docs, "n_replaced")
    # Columns of the input stay in a struct: no name of theirs can meet one used here.
    packed = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    whole = F.col("_text")
    settled = settle(entities(packed, "_text"), key, attempts)
    late = cut_lineage(settled.filter("attempt > 0").select("kind", "norm", "attempt"))
    rows = packed.withColumn("_found", matches(whole))
    if late.isEmpty():
        rows = rows.withColumn("_late", F.lit(None).cast("map<string,int>"))
    else:
        keyed = packed.select(F.md5(whole.cast("binary")).alias("_print"), F.explode(mentions(whole)).alias("surface"))
        keyed = keyed.withColumn("kind", type_of(F.col("surface"))).withColumn("norm", normal_form(F.col("kind"), F.col("surface")))
        of_text = keyed.join(small_side(late), ["kind", "norm"]).groupBy("_print").agg(
            F.map_from_entries(F.collect_set(F.struct(F.concat_ws("\u0001", "kind", "norm"), "attempt"))).alias("_late")
        )
        rows = rows.withColumn("_print", F.md5(whole.cast("binary"))).join(
            small_side(cut_lineage(of_text)), "_print", "left"
        ).drop("_print")

    def replace(surface):
        return F.when(_is_run(surface), _let(_card_pattern(surface), lambda p: joined(
            F.split(surface, p, -1), F.regexp_extract_all(surface, p, F.lit(0)), replace_one
        ))).otherwise(replace_one(surface))

    def joined(between, found, change):
        return F.array_join(F.zip_with(between, F.transform(found, change), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")

    def replace_one(surface):
        typed = F.struct(surface.alias("surface"), type_of(surface).alias("kind"))
        return _let(typed, lambda t: F.when(t["kind"].isNull(), t["surface"]).otherwise(named(t)))

    def named(t):
        entity = F.struct(t["surface"].alias("surface"), t["kind"].alias("kind"), normal_form(t["kind"], t["surface"]).alias("norm"))
        return _let(entity, made)

    def made(w):
        attempt = F.coalesce(F.try_element_at(F.col("_late"), F.concat_ws("\u0001", w["kind"], w["norm"])), F.lit(0))
        return _let(core(key, w["kind"], w["norm"], attempt), lambda m: rendered(w["kind"], w["surface"], m))

    rewritten = joined(F.split(whole, ANY, -1), F.col("_found"), replace)
    count = F.size(F.filter(_within(F.col("_found")), lambda s: type_of(s).isNotNull()))
    changed = F.when(F.size("_found") > 0, rewritten).otherwise(whole)
    names = [F.col("_row").getField(c).alias(c) if c != text else changed.alias(text) for c in kept.columns]
    return rows.select(*names, count.alias("n_replaced"))
