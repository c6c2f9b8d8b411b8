"""Personal data replaced by keyed surrogates of the same kind.

Only DataFrame functions. Entities are found by pattern and each is replaced where it stands. A surrogate comes from a keyed
permutation of all strings of its format (four rounds: either half of the characters is shifted, each within its alphabet, by
a digest of key and other half). A permutation gives equal entities equal surrogates and different ones different ones,
without a table of what was seen; ``collisions`` checks exactly that over a whole table. Letter case, script, digits and
punctuation keep their places; a card number keeps its check digit right or wrong; known given names are exchanged within
their gender and script.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Given names by gender and script, and titles.
GIVEN_NAMES = (
    ("James", "John", "Robert", "Michael", "William", "David", "Richard", "Joseph", "Thomas", "Charles", "Hans", "Peter", "Klaus", "Jürgen", "Pierre",
     "Jean", "Louis", "Carlos", "José", "Juan", "Luis", "Paulo", "João", "Pedro"),
    ("Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Jessica", "Sarah", "Karen", "Anna", "Ursula", "Monika", "Sabine",
     "Marie", "Claire", "Sophie", "María", "Carmen", "Lucía", "Ana", "Joana", "Inês", "Teresa"),
    ("Иван", "Александр", "Сергей", "Дмитрий", "Николай", "Михаил"),
    ("Анна", "Мария", "Ольга", "Елена", "Наталья", "Татьяна"),
    ("Γιώργος", "Δημήτρης", "Νίκος", "Κώστας", "Παναγιώτης"),
    ("Μαρία", "Ελένη", "Κατερίνα", "Βασιλική", "Σοφία"),
)
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Señor", "Señora", "Sr", "Sra", "Senhor", "Senhora",
          "Господин", "Госпожа", "Κύριος", "Κυρία")

DIGITS = ("0123456789",)
HEX = ("0123456789", "abcdef", "ABCDEF")
LETTERS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
# Vowels stay vowels, so that names can be spoken.
SPOKEN = ("aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "áéíóúàèìòùâêîôûäëïöüãõ", "ÁÉÍÓÚÀÈÌÒÙÂÊÎÔÛÄËÏÖÜÃÕ", "çñ", "ÇÑ",
          "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "АЕЁИОУЫЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ",
          "αεηιουωάέήίόύώ", "βγδζθκλμνξπρστφχψς", "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ")

_octet = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_hextet = r"[0-9A-Fa-f]{1,4}"
_capital = r"\p{Lu}[\p{L}'-]+"
PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?\.[A-Za-z]{2,}",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "ip": rf"(?<![0-9.])(?:{_octet}\.){{3}}{_octet}(?![0-9]|\.[0-9])",
    # All eight groups, or fewer around ::, at least one on either side or three after it.
    "ipv6": rf"(?<![0-9A-Za-z:.])(?:(?:{_hextet}:){{7}}{_hextet}|(?:{_hextet}:){{1,6}}(?::{_hextet}){{1,6}}|(?:{_hextet}:){{2,7}}:|::{_hextet}(?::{_hextet}){{2,6}})(?![0-9A-Za-z:])",
    # A country code and 7 to 15 digits in groups of any size; a national number; ten digits in one, or up to eleven after a 0.
    "phone": r"(?<![0-9])(?:\+[1-9](?:[ ./-]{0,2}\(?[0-9]\)?){6,14}(?![0-9])|(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])?[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9])(?<![0-9][.,])(?:[2-9][0-9]{9}|0[1-9][0-9]{8,9})(?![0-9]))",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "ssn": r"(?<![0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])",
    "name": rf"(?<![\p{{L}}])(?:(?:{'|'.join(TITLES)})\.?(?: {_capital}){{1,3}}|(?:{'|'.join(n for g in GIVEN_NAMES for n in g)})(?: {_capital}){{1,2}})",
}
# A text without any of these holds no entity.
HINT = rf"[0-9@]|::|{'|'.join(TITLES)}|{'|'.join(n for g in GIVEN_NAMES for n in g)}"


def quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def shifted(text: str, digest: str, alphabets: tuple[str, ...]) -> str:
    """SQL: every character of ``text`` moved within its alphabet by a byte of ``digest``; others stay."""
    step = f"cast(conv(substr({digest}, (i % 64) * 2 + 1, 2), 16, 10) as int)"
    cases = " ".join(f"WHEN instr({quoted(a)}, substr({text}, i, 1)) > 0 THEN substr({quoted(a)}, (instr({quoted(a)}, substr({text}, i, 1)) - 1 + {step}) % {len(a)} + 1, 1)"
                     for a in alphabets)
    return f"if({text} = '', '', array_join(transform(sequence(1, length({text})), i -> CASE {cases} ELSE substr({text}, i, 1) END), ''))"


def permuted(text: str, key: str, alphabets: tuple[str, ...]) -> str:
    """SQL: the keyed permutation. Halves change places each round, so that after four they are back."""
    start = f"named_struct('a', substr({text}, 1, length({text}) div 2), 'b', substr({text}, length({text}) div 2 + 1))"
    digest = f"sha2(concat_ws('|', {quoted(key)}, r, length(s.a), s.b), 512)"
    # The digest is bound once per round.
    turn = f"(s, r) -> element_at(transform(array({digest}), h -> named_struct('a', s.b, 'b', {shifted('s.a', 'h', alphabets)})), 1)"
    return f"aggregate(array(1, 2, 3, 4), {start}, {turn}, s -> concat(s.a, s.b))"


def check_digit(digits: str) -> str:
    """SQL: the digit that makes ``digits`` and itself pass the Luhn test."""
    doubled = f"aggregate(sequence(1, length({digits})), 0, (t, i) -> t + element_at(array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9), cast(substr({digits}, length({digits}) - i + 1, 1) as int) + 1) * (i % 2)" \
              f" + cast(substr({digits}, length({digits}) - i + 1, 1) as int) * ((i + 1) % 2))"
    return f"((10 - {doubled} % 10) % 10)"


def card_surrogate(e: str, key: str) -> str:
    """All digits but the last permuted; the last keeps its distance from the right check digit."""
    body = f"regexp_replace(substr({e}, 1, length({e}) - 1), '[^0-9]', '')"
    new = permuted("d", key, DIGITS)
    last = f"cast(pmod({check_digit('n')} + cast(substr({e}, -1) as int) - {check_digit('d')}, 10) as string)"
    # Digits go back to the places digits stood at.
    place = "length(regexp_replace(substr(e, 1, i), '[^0-9]', ''))"
    spread = f"array_join(transform(sequence(1, length({e})), i -> if(substr({e}, i, 1) BETWEEN '0' AND '9', substr(w, {place.replace('(e,', '(' + e + ',')}, 1), substr({e}, i, 1))), '')"
    return f"element_at(transform(array({body}), d -> element_at(transform(array({new}), n -> element_at(transform(array(concat(n, {last})), w -> {spread}), 1)), 1)), 1)"


def ip_surrogate(e: str, key: str) -> str:
    """The address as two 16-bit halves, each moved by a digest of the other, four times."""
    part = lambda i: f"cast(split({e}, '[.]')[{i}] as int)"
    start = f"named_struct('a', {part(0)} * 256 + {part(1)}, 'b', {part(2)} * 256 + {part(3)})"
    turn = f"(s, r) -> named_struct('a', s.b, 'b', (s.a + cast(conv(substr(sha2(concat_ws('|', {quoted(key)}, 'ip', r, s.b), 256), 1, 6), 16, 10) as int)) % 65536)"
    return f"aggregate(array(1, 2, 3, 4), {start}, {turn}, s -> concat_ws('.', s.a div 256, s.a % 256, s.b div 256, s.b % 256))"


def name_surrogate(e: str, key: str) -> str:
    """Word by word: titles stay, given names move within their list, other words are permuted around the lists."""
    import hashlib

    cases = []
    for i, names in enumerate(GIVEN_NAMES):
        move = 1 + int(hashlib.sha256(f"{key}|{i}".encode()).hexdigest(), 16) % (len(names) - 1)
        listed = f"array({', '.join(map(quoted, names))})"
        cases.append(f"WHEN array_contains({listed}, w) THEN element_at({listed}, cast((array_position({listed}, w) - 1 + {move}) % {len(names)} + 1 as int))")
    kept = f"array({', '.join(quoted(x) for t in TITLES for x in (t, t + '.'))})"
    lists = f"array({', '.join(map(quoted, [n for g in GIVEN_NAMES for n in g]))})"
    walk = f"aggregate(array(1, 2, 3), {permuted('w', key, SPOKEN)}, (x, q) -> if(array_contains({lists}, x), {permuted('x', key, SPOKEN)}, x))"
    word = f"CASE WHEN array_contains({kept}, w) THEN w {' '.join(cases)} ELSE {walk} END"
    return f"array_join(transform(split({e}, ' '), w -> {word}), ' ')"


def surrogate(e: str, key: str) -> str:
    """SQL: the surrogate of entity ``e``, by the first kind whose pattern it fits as a whole."""
    whole = lambda kind: f"{e} RLIKE {quoted('^(?:' + PATTERNS[kind] + ')$')}"
    # The top-level domain and a phone's country code stay.
    email = f"concat({permuted(f'substring_index({e}, chr(64), 1)', key, LETTERS)}, '@', element_at(transform(array(regexp_extract({e}, '@(.*)[.][A-Za-z]+$', 1)), o -> {permuted('o', key, LETTERS)}), 1), regexp_extract({e}, '[.][A-Za-z]+$', 0))"
    code = f"regexp_extract({e}, '^[+][0-9]+(?=[^0-9])', 0)"
    phone = f"concat({code}, element_at(transform(array(substr({e}, length({code}) + 1)), o -> {permuted('o', key, DIGITS)}), 1))"
    iban = f"concat(substr({e}, 1, 2), element_at(transform(array(substr({e}, 3)), o -> {permuted('o', key, LETTERS)}), 1))"
    return (f"CASE WHEN {whole('email')} THEN {email} WHEN {whole('secret')} THEN {permuted(e, key, HEX)} WHEN {whole('iban')} THEN {iban}"
            f" WHEN {whole('ip')} THEN {ip_surrogate(e, key)} WHEN {whole('ipv6')} THEN {permuted(e, key, HEX)} WHEN {whole('phone')} THEN {phone} WHEN {whole('card')} THEN {card_surrogate(e, key)}"
            f" WHEN {whole('ssn')} THEN {permuted(e, key, DIGITS)} ELSE {name_surrogate(e, key)} END")


def any_entity() -> str:
    return "|".join(f"(?:{p})" for p in PATTERNS.values())


def entities(text: Column) -> Column:
    """The entities of a text in order, repeats included; empty for null."""
    some = F.regexp_extract_all(text, F.lit(any_entity()), F.lit(0))
    return F.when(F.coalesce(text.rlike(HINT), F.lit(False)), some).otherwise(F.array().cast("array<string>"))


def replace_entities(docs: DataFrame, secret: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, text with every entity replaced, and how many there were.

    No shuffle and no table of entities: the work is per row, whatever repeats. A null text stays null; an empty one empty; repeated rows
    give equal rows; an empty table none; other columns are not read.
    """
    found = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).withColumn("found", entities(F.col("text")))
    new = found.withColumn("new", F.when(F.size("found") > 0, F.expr(f"transform(found, e -> {surrogate('e', secret)})")))
    parts = F.split(F.col("text"), any_entity(), -1)
    woven = F.array_join(F.flatten(F.zip_with(parts, F.concat("new", F.array(F.lit(""))), lambda p, n: F.array(p, n))), "")
    return new.select("doc_id", F.when(F.size("found") > 0, woven).otherwise(F.col("text")).alias("text"), F.size("found").alias("n_entities"))


def surrogate_table(docs: DataFrame, secret: str, text: str = "text") -> DataFrame:
    """Every distinct entity of a table with its surrogate."""
    found = docs.select(F.explode(entities(F.col(text))).alias("entity")).distinct()
    return found.withColumn("surrogate", F.expr(surrogate("entity", secret)))


def collisions(docs: DataFrame, secret: str, text: str = "text") -> DataFrame:
    """Surrogates shared by several entities: none, if all is well."""
    return surrogate_table(docs, secret, text).groupBy("surrogate").agg(F.count("*").alias("n")).where("n > 1")
