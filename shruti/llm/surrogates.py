"""Personal data: detected entities are replaced by keyed, type-consistent surrogates.

A surrogate is the image of the entity under a keyed permutation of the strings
of its own format: letters stay letters of their case, script and kind (vowel or
consonant, where names are spoken), digits stay digits, separators stay, check
digits (card, bank account) are made anew, listed first names go to listed first
names of the same gender and script. The same entity has the same surrogate in
every document (coreference), however it is written; different ones have
different surrogates (distinctness), as the map is a permutation without fixed
points. Nothing has to be agreed on between tasks, so replacing is one pass over
the rows. A check of each row, and one pass over the whole corpus before
(``confirm``), make sure that no two entities share a surrogate.

Defined results: a null text stays null, an empty one empty; repeated rows are
replaced alike; rows without entities are unchanged; an empty table gives no
rows; further columns pass through ``pseudonymise``. Spans are code points of
the original text, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, per_batch

#: Fixed word lists: first names by script and gender, and forms of address by gender.
FIRST_NAMES = {
    ("latin", "f"): "Alice Amelia Anna Bianca Carla Carmen Caroline Charlotte Claire Daniela Diana Elena Elisabeth Emily Emma Eva Hannah Helena Isabel Jennifer Jessica Johanna Julia Karen Katharina Laura Linda Louise Lucia Maria Martha Mary Michelle Monika Nicole Olivia Patricia Rosa Sandra Sarah Sofia Sophie Susan Teresa Ursula Valentina Victoria".split(),
    ("latin", "m"): "Alexander Andreas Antonio Benjamin Carlos Charles Christian Daniel David Diego Eduardo Eric Fernando Frank Georg George Hans Harry Henry Jack Jacob James Javier Johannes John Joseph Juan Karl Lucas Luis Manuel Mark Martin Matthew Michael Miguel Oliver Pablo Patrick Paul Peter Philip Pierre Robert Stefan Thomas William".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Екатерина Елена Ирина Ксения Лариса Мария Наталья Нина Ольга Светлана Татьяна Юлия".split(),
    ("cyrillic", "m"): "Александр Алексей Андрей Антон Борис Виктор Владимир Дмитрий Иван Игорь Максим Михаил Николай Олег Павел Сергей".split(),
}
TITLES = {"f": "Mrs Ms Miss Frau Madame Mme Señora Sra Signora Госпожа".split(), "m": "Mr Sir Herr Monsieur Señor Sr Signor Господин".split(), "": "Dr Prof".split()}
ALPHABETS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"]
SPOKEN = ["aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóúàèìòùâêîôûäëïöü", "ñçß", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ"]
SPOKEN += [s.upper() for s in SPOKEN[:3] + ["ñç"] + SPOKEN[4:]]

GENDER_OF_NAME = {n: k for k, names in FIRST_NAMES.items() for n in names}
GENDER_OF_TITLE = {t: g for g, ts in TITLES.items() for t in ts}
_CAP = r"[A-ZÀ-ÖØ-ÞА-ЯЁΑ-Ω][a-zà-öø-ÿа-яёα-ω]+(?:-[A-ZÀ-ÖØ-ÞА-ЯЁΑ-Ω][a-zà-öø-ÿа-яёα-ω]+)?"
PATTERNS = [
    ("email", re.compile(r"[A-Za-z0-9_%+'-]+(?:\.[A-Za-z0-9_%+'-]+)*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}"), "@"),
    ("iban", re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"), ""),
    ("ip", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\w|\.\d)", re.ASCII), "."),
    ("card", re.compile(r"(?<!\w)(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5})(?!\w)", re.ASCII), ""),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", re.ASCII), "-"),
    ("phone", re.compile(r"(?<![\w+])\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\w+])\+(?!1\b)\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)|(?<![\w.+-])(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])", re.ASCII), ""),
    ("name", re.compile(rf"\b(?:(?P<title>{'|'.join(t for ts in TITLES.values() for t in ts)})\.?[ ]+(?P<titled>{_CAP}(?:[ ]{_CAP})?)|(?P<first>{'|'.join(GENDER_OF_NAME)})[ ](?P<last>{_CAP}))\b"), ""),
]
#: The country code (one or two digits for those assigned, else three) with a trunk zero in brackets; what follows is the national number.
COUNTRY = re.compile(r"\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}|\d{1,2}(?=[ .(-]))(?:[ .-]?\(0\))?", re.ASCII)
ANY_NUMBER = re.compile(r"\d[\d ().-]{5,}\d|\d\.\d+\.\d", re.ASCII)
ANY_NAME = re.compile(rf"\b(?:{'|'.join([*GENDER_OF_TITLE, *GENDER_OF_NAME])})\b")


class Permutation:
    """Keyed permutations without fixed points of the tuples of digits with given radices."""

    def __init__(self, key: bytes, rounds: int = 10):
        self.key, self.rounds = key, rounds

    def _number(self, kind: str, r: int, value: int, below: int) -> int:
        size = (below.bit_length() + 7) // 8 + 8
        raw = b""
        seed = f"{kind}|{r}|{below}|{value}".encode()
        while len(raw) < size:
            raw += hashlib.blake2b(seed + len(raw).to_bytes(4, "big"), key=self.key[:64], digest_size=64).digest()
        return int.from_bytes(raw[:size], "big") % below

    def __call__(self, kind: str, digits: list[int], radices: list[int]) -> list[int]:
        half = len(digits) // 2
        a, m = _join(digits[:half], radices[:half])
        b, n = _join(digits[half:], radices[half:])
        if m * n < 2:
            return digits
        for r in range(self.rounds):  # there
            a = (a + self._number(kind, 2 * r, b, m)) % m
            b = (b + self._number(kind, 2 * r + 1, a, n)) % n
        a, b = divmod((a * n + b + 1) % (m * n), n)  # the next in one cycle of all
        for r in reversed(range(self.rounds)):  # and back
            b = (b - self._number(kind, 2 * r + 1, a, n)) % n
            a = (a - self._number(kind, 2 * r, b, m)) % m
        return _split(a, radices[:half]) + _split(b, radices[half:])


def _join(digits: list[int], radices: list[int]) -> tuple[int, int]:
    value = size = 1
    value = 0
    for d, r in zip(digits, radices):
        value, size = value * r + d, size * r
    return value, size


def _split(value: int, radices: list[int]) -> list[int]:
    out = []
    for r in reversed(radices):
        value, d = divmod(value, r)
        out.append(d)
    return out[::-1]


def luhn(digits: list[int]) -> int:
    """The check digit after ``digits``."""
    return -sum((d * 2 - 9 * (d > 4)) if i % 2 == 0 else d for i, d in enumerate(reversed(digits))) % 10


def mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


class Surrogates:
    """Detection and replacement in one text."""

    def __init__(self, key: bytes):
        self.permute = Permutation(key)
        self.known: dict[tuple[str, str], str] = {}

    def _letters(self, kind: str, text: str, alphabets: list[str]) -> str:
        """Each character goes to one of its alphabet; the whole text is permuted at once. Case is kept but counts for nothing."""
        places = [(i, low, a) for i, c in enumerate(text) for a, low in [next(((a, c) for a in alphabets if c in a), (None, c))] if a]
        digits = self.permute(kind + "|" + _form(text), [a.lower().index(c.lower()) for _, c, a in places], [len(a) for *_, a in places])
        out = list(text)
        for (i, _, a), d in zip(places, digits):
            out[i] = a[d]
        return "".join(out)

    def email(self, text: str) -> str:
        local, domain = text.rsplit("@", 1)
        *labels, top = domain.split(".")
        kept = labels.pop() if labels and labels[-1].lower() == "example" else None  # reserved for examples: nobody's
        host = ".".join([*([self._letters("domain", ".".join(labels), ALPHABETS)] if labels else []), *([kept] if kept else []), top])
        return f"{self._letters('local', local, ALPHABETS)}@{host}"

    def numbers(self, kind: str, text: str, keep: int = 0, last: int = 0) -> str:
        """Digits permuted but for ``keep`` at the start and ``last`` at the end; a leading 0 or 1 stays one of them."""
        at = [i for i, c in enumerate(text) if c.isdigit()]
        all_digits = [int(text[i]) for i in at]
        digits = all_digits[keep : len(at) - last]
        low = [0 if i else 2 if d > 1 else 0 for i, d in enumerate(digits)]
        radices = [10 if i else 8 if d > 1 else 2 for i, d in enumerate(digits)]
        new = self.permute(f"{kind}|{all_digits[:keep]}", [d - x for d, x in zip(digits, low)], radices)
        all_digits[keep : len(at) - last] = [d + x for d, x in zip(new, low)]
        if kind == "card":
            all_digits[-1] = luhn(all_digits[:-1])
        out = list(text)
        for i, d in zip(at, all_digits):
            out[i] = str(d)
        return "".join(out)

    def phone(self, text: str) -> str:
        code = COUNTRY.match(text)
        return text[: code.end()] + self.numbers("phone", text[code.end() :]) if code else self.numbers("phone", text)

    def ip(self, text: str) -> str:
        octets = list(map(int, text.split(".")))
        special = {0, 10, 127, 169, 172, 192}
        usual = [x for x in range(1, 224) if x not in special]
        if octets[0] in usual:
            new = self.permute("ip", [usual.index(octets[0]), *octets[1:]], [len(usual), 256, 256, 256])
            new[0] = usual[new[0]]
        else:
            new = octets[:2] + self.permute(f"ip|{octets[:2]}", octets[2:], [256, 256])
        return ".".join(map(str, new))

    def iban(self, text: str) -> str:
        plain = text.replace(" ", "")
        body = self._letters("iban" + plain[:2], plain[4:], ALPHABETS)
        new = f"{plain[:2]}{98 - mod97(body + plain[:2] + '00'):02d}{body}"
        spaces = [i for i, c in enumerate(text) if c == " "]
        for i in spaces:
            new = new[:i] + " " + new[i:]
        return new

    def first_name(self, text: str) -> str:
        names = FIRST_NAMES[GENDER_OF_NAME[text]]
        return names[self.permute(f"first|{GENDER_OF_NAME[text]}", [names.index(text)], [len(names)])[0]]

    def surname(self, text: str) -> str:
        return self._letters("surname", text, SPOKEN)

    def of(self, kind: str, text: str) -> str:
        if (kind, text) not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            make = {"email": self.email, "iban": self.iban, "ip": self.ip, "phone": self.phone, "first": self.first_name, "last": self.surname}.get(kind)
            self.known[kind, text] = make(text) if make else self.numbers(kind, text, keep=1 if kind == "card" else 0, last=1 if kind == "card" else 0)
        return self.known[kind, text]

    def find(self, text: str) -> list[tuple[int, int, str]]:
        """Entities, leftmost first, not overlapping; of two at one place the kind listed first."""
        numbers, names = ANY_NUMBER.search(text), ANY_NAME.search(text)
        found: list[tuple[int, int, str]] = []
        rest = text  # what is found is blanked, so that it can't be part of anything else
        for kind, pattern, needs in PATTERNS:
            if needs and needs not in text or not (names if kind == "name" else numbers or kind in ("email", "iban")):
                continue
            new = [s for m in pattern.finditer(rest) if _valid(kind, m[0]) for s in (_name_parts(m) if kind == "name" else [(*m.span(), kind)])]
            found += new
            rest = _blanked(rest, new)
        known = {text[a:b]: k for want in ("first", "last") for a, b, k in found if k == want}
        if known:  # other mentions, of the first or the last name alone
            either = "|".join(sorted(map(re.escape, known), key=len, reverse=True))
            found += [(*m.span(), known[m[0]]) for m in re.finditer(rf"\b(?:{either})\b", rest)]
        return sorted(found)

    def replace(self, text: str) -> tuple[str, list[tuple[int, int, str]], list[tuple[str, str, str]]]:
        """The new text, the spans found, and (kind, canonical entity, canonical surrogate) of each."""
        spans = self.find(text)
        out, at, pairs = [], 0, []
        for a, b, kind in spans:
            new = self.of(kind, text[a:b])
            out += [text[at:a], new]
            at = b
            pairs.append((kind, canonical(kind, text[a:b]), canonical(kind, new)))
        by_new = {}
        for kind, old, new in pairs:
            if by_new.setdefault((kind, new), old) != old:
                raise ValueError(f"surrogates of kind {kind} collide")
        return "".join([*out, text[at:]]), spans, pairs


def _blanked(text: str, spans: list[tuple[int, int, str]]) -> str:
    if not spans:
        return text
    parts, at = [], 0
    for a, b, _ in spans:
        parts += [text[at:a], "\0" * (b - a)]
        at = b
    return "".join([*parts, text[at:]])


def canonical(kind: str, text: str) -> str:
    """The form that all ways of writing the entity share."""
    if kind == "email":
        return text.lower()
    if kind == "phone":
        return re.sub(r"\D", "", COUNTRY.sub("", text, count=1))
    return text if kind in ("first", "last", "ip") else re.sub(r"[ -]", "", text)


def _form(text: str) -> str:
    """What a permutation keeps: kinds of characters, whatever their case."""
    return "".join("a" if c.isalpha() else "0" if c.isdigit() else c for c in text)


def _valid(kind: str, text: str) -> bool:
    if kind == "card":
        digits = [int(c) for c in text if c.isdigit()]
        return len(set(digits)) > 1 and luhn(digits[:-1]) == digits[-1]
    if kind == "iban":
        plain = text.replace(" ", "")
        return 15 <= len(plain) <= 34 and mod97(plain[4:] + plain[:4]) == 1
    if kind == "phone":
        digits = sum(c.isdigit() for c in text)
        return 7 <= digits <= 15
    return True


def _name_parts(m: re.Match) -> list[tuple[int, int, str]]:
    if m["first"]:
        return [(*m.span("first"), "first"), (*m.span("last"), "last")]
    at, parts = m.start("titled"), []
    for word in m["titled"].split(" "):
        parts.append((at, at + len(word), "first" if word in GENDER_OF_NAME and " " in m["titled"] and not parts else "last"))
        at += len(word) + 1
    return parts


SPANS = "spans"


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", spans: str | None = None) -> DataFrame:
    """``docs`` with surrogates in the text; ``spans``: name of a further column kind:start:end, comma-joined."""
    fields = docs.schema.fields
    names = docs.columns
    made: list[Surrogates] = []
    n_text = names.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not made:
            made.append(Surrogates(key))
        new, found = [], []
        for t in column(batch, text).to_pylist():
            replaced, where, _ = made[0].replace(t) if t else (t, [], [])
            new.append(replaced)
            found.append(",".join(f"{k}:{a}:{b}" for a, b, k in where))
        columns = list(batch.columns)
        columns[n_text] = pa.array(new, pa.string())
        return pa.RecordBatch.from_arrays(columns + [pa.array(found, pa.string())] * bool(spans), names=[*names, *([spans] * bool(spans))])

    return docs.mapInArrow(per_batch(run), T.StructType([*fields, *([T.StructField(spans, T.StringType())] if spans else [])]))


def collisions(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """kind, surrogate and count of entities of each surrogate that stands for several; empty unless something is wrong.

    Entities are made distinct before the shuffle by kind and surrogate.
    """
    made: list[Surrogates] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not made:
            made.append(Surrogates(key))
        rows = sorted({p for t in column(batch, text).to_pylist() if t for p in made[0].replace(t)[2]})
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], names=["kind", "entity", "surrogate"])

    pairs = docs.select(text).mapInArrow(per_batch(run), "kind string, entity string, surrogate string").distinct()
    return pairs.groupBy("kind", "surrogate").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def confirm(docs: DataFrame, key: bytes, text: str = "text") -> None:
    """An error if two entities of the whole corpus share a surrogate."""
    found = collisions(docs, key, text).limit(1).collect()
    if found:
        raise ValueError(f"surrogates of kind {found[0].kind} collide")


def digest(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, text (with surrogates; null: empty), n_entities, spans of each document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    confirm(rows, key)
    out = pseudonymise(rows, key, spans=SPANS)
    return out.select("doc_id", "text", F.when(F.col(SPANS) == "", 0).otherwise(F.size(F.split(SPANS, ","))).cast("long").alias("n_entities"), SPANS)
