"""Personal data replaced by surrogates of the same kind.

Entities are found in whole texts. Each distinct entity of the corpus gets a keyed surrogate of its type,
format and script, a name one of its gender too, so all its mentions agree everywhere. Names are known by a title
or a listed given name; in the same text their parts are mentions by themselves as well. Surrogates that two
entities share, or that are real entities themselves, are found by grouping and drawn again. Only those
drawn again have to be looked up; the others follow from the entity and the key.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import discard, ready, store

# Titles by gender, and given names that are taken for a name without a title.
TITLES = {
    "m": "Mr Mister Sir Herr Monsieur M Sr Señor Don Mr. Sr. M. г-н господин",
    "f": "Mrs Ms Miss Madam Frau Madame Mme Mlle Sra Srta Señora Doña Mrs. Ms. Mme. Sra. Srta. г-жа госпожа",
    "n": "Dr Prof Dr. Prof.",
}
GIVEN = {
    "m": "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Peter Paul Mark George "
    "Hans Klaus Jürgen Wolfgang Pierre Jean Jacques Luc José Juan Carlos Miguel Antonio Иван Пётр Алексей Сергей",
    "f": "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Anna Emma Laura Julia Helga Ursula "
    "Ingrid Sabine Marie Claire Camille Sophie María Carmen Lucía Elena Isabel Анна Мария Ольга Елена",
}
GENDER = {name: gender for gender, names in GIVEN.items() for name in names.split()}
TITLE_GENDER = {title: gender for gender, titles in TITLES.items() for title in titles.split()}
# Words that begin sentences, so that one taken for a name behind a title is not looked for elsewhere.
NO_NAMES = frozenset(
    "The This That These Those An And But He She It We You They Is Are Was In On At For Of To Not Der Die Das Und Ein Eine "
    "Er Sie Es Wir Le La Les Un Une Et Il Elle El Los Las Una Él Ella В На Он Она Это И".split()
)
NAME = r"[A-ZÀ-ÖØ-ÞΑ-ΩА-ЯЁ][\wà-öø-ÿα-ωа-яё]+(?:-[A-ZÀ-ÖØ-ÞА-ЯЁ][\wà-öø-ÿа-яё]+)?"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_%+-.")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
ENDING = re.compile(r"[A-Za-z]{2,}")
NUMBER = re.compile(r"(?<![\w.+])(?:\+\d|\(\d|\d)[\d ().\-]{5,}\d(?!\w)")
CARD = re.compile(r"(?:4|5[1-5]|2[2-7]|35|6)\d*|3[0468-9]\d{12}|3[47]\d{13}")  # how known issuers' numbers begin
SSN = re.compile(r"\d{3}-\d{2}-\d{4}")
IP = re.compile(r"(?:\d{1,3}\.){3}\d{1,3}")
PHONE = re.compile(r"\+?(?:\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3,4}[ .-]?\d{3,4}")
IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?\b")
AWS = re.compile(r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b")
HEX = re.compile(r"(?<![0-9A-Za-z])[0-9a-f]{32,128}(?![0-9A-Za-z])")
ASSIGNED = re.compile(r"(?i:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?([^\s\"'<>,;]{6,})")
TITLED = re.compile(rf"(?<!\w)({'|'.join(re.escape(t) for t in sorted(TITLE_GENDER, key=len, reverse=True))})\s+({NAME})(?:\s+({NAME}))?")
NAMED = re.compile(rf"(?<!\w)({'|'.join(GENDER)})\s+({NAME})")


@dataclass(frozen=True, order=True)
class Mention:
    start: int
    end: int
    kind: str  # with the gender for names: given_f, given_m, given_n, surname
    value: str  # as it is looked up: without differences of spacing and letter case that mean nothing


def luhn(digits: str) -> int:
    """The sum that is divisible by ten for a valid card number."""
    return sum(sum(divmod(int(d) * 2, 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))


def cards(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Spans of card numbers in a run of numbers: 13 to 19 digits from the start to the end of groups, valid by Luhn.

    Where such spans overlap, one that begins like an issuer's number goes before others, then the longer one.
    """
    groups = [m.span() for m in re.finditer(r"[0-9]+", text[start:end])]
    found = []
    for i, (first, _) in enumerate(groups):
        digits = ""
        for j in range(i, len(groups)):
            a, b = groups[j]
            between = text[start + groups[j - 1][1] : start + a]
            if j > i and between not in (" ", "-") or len(digits) + b - a > 19:
                break
            digits += text[start + a : start + b]
            if len(digits) >= 13 and luhn(digits) % 10 == 0:
                found.append((not CARD.fullmatch(digits), -len(digits), start + first, start + b))
    out: list[tuple[int, int]] = []
    for _, _, a, b in sorted(found):
        if all(b <= x or a >= y for x, y in out):
            out.append((a, b))
    return out


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Where mail addresses stand: words with single dots between them, on both sides of an @, the last of letters.

    Each character is looked at from the @ before it and the one behind it only, whatever stands between.
    """
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        local = text[start:at]
        local = local[local.rfind("..") + 2 :] if ".." in local else local.removeprefix(".")
        domain = DOMAIN.match(text, at + 1)
        if local and not local.endswith(".") and domain:
            labels = domain[0].split(".")
            stop = domain.end()
            for label in reversed(labels[1:]):
                begin = stop - len(label)
                if ending := ENDING.match(text, begin, stop):
                    done = ending.end()
                    yield at - len(local), done
                    break
                stop = begin - 1
        at = text.find("@", at + 1)


def mentions(text: str | None) -> list[Mention]:
    """What a text says about persons and secrets, in order, none overlapping; null and empty texts have none."""
    text = text or ""
    found: list[tuple[int, Mention]] = []  # with a rank: the smaller wins where spans overlap

    def add(rank: int, kind: str, start: int, end: int, value: str) -> None:
        found.append((rank, Mention(start, end, kind, value)))

    if "@" in text:
        for start, end in addresses(text):
            add(0, "email", start, end, text[start:end].lower())
    for m in ASSIGNED.finditer(text):
        add(1, "secret", *m.span(1), m[1])
    for m in AWS.finditer(text) if "KIA" in text or "SIA" in text else ():
        add(0, "secret", *m.span(), m[0])
    for m in HEX.finditer(text):
        add(2, "secret", *m.span(), m[0])
    for m in IBAN.finditer(text):
        plain = m[0].replace(" ", "")
        if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
            add(0, "iban", *m.span(), plain)
    for m in NUMBER.finditer(text):
        for a, b in cards(text, *m.span()) if m.end() - m.start() >= 13 else ():
            add(1, "card", a, b, re.sub(r"\D", "", text[a:b]))
        for rank, kind, pattern in ((2, "ssn", SSN), (2, "ip", IP), (3, "phone", PHONE)):
            for p in pattern.finditer(text, m.start(), m.end()):
                around = text[p.start() - 1 : p.start()], text[p.end() : p.end() + 1]
                digits = re.sub(r"\D", "", p[0])
                if around[0].isdigit() or around[1].isdigit():
                    continue
                if kind == "ip" and any(int(part) > 255 for part in p[0].split(".")):
                    continue
                if kind == "phone" and (len(digits) < 9 or not re.search(r"[ ().+-]", p[0])):
                    continue
                add(rank, kind, *p.span(), p[0] if kind == "ip" else digits)
    for m in TITLED.finditer(text):
        gender = TITLE_GENDER[m[1]]
        gender = GENDER.get(m[2], gender) if gender == "n" else gender
        if m[3] and not m[2].endswith("."):
            add(4, f"given_{gender}", *m.span(2), m[2])
            add(4, "surname", *m.span(3), m[3])
        else:
            add(4, "surname", *m.span(2), m[2])
    for m in NAMED.finditer(text):
        add(5, f"given_{GENDER[m[1]]}", *m.span(1), m[1])
        add(5, "surname", *m.span(2), m[2])
    # the same names without a title or a given name; in capitals too
    names: dict[str, tuple[str, str]] = {}
    for _, m in found:
        if m.kind == "surname" or m.kind.startswith("given_"):
            if m.value not in NO_NAMES:
                names.setdefault(m.value, (m.kind, m.value))
    for value, entity in list(names.items()):
        names.setdefault(value.upper(), entity)
    if names:
        words = "|".join(map(re.escape, sorted(names, key=len, reverse=True)))
        for m in re.finditer(rf"(?<!\w)(?:{words})(?!\w)", text):
            kind, value = names[m[0]]
            add(6, kind, *m.span(), value)
    out: list[Mention] = []  # in order of their places, none overlapping
    for _, m in sorted(found, key=lambda x: (x[0], x[1].start - x[1].end, x[1])):
        at = bisect_left(out, m.start, key=lambda x: x.start)
        if (at == 0 or out[at - 1].end <= m.start) and (at == len(out) or m.end <= out[at].start):
            out.insert(at, m)
    return out


class Stream:
    """Numbers that follow from a key, an entity and an attempt."""

    def __init__(self, key: str, kind: str, value: str, attempt: int):
        self.seed = f"{kind}\x1f{value}\x1f{attempt}".encode()
        self.key, self.bits, self.count = key.encode()[:64], 0, 0

    def below(self, n: int) -> int:
        if self.bits < 1 << 64:
            digest = hashlib.blake2b(self.seed + self.count.to_bytes(4, "big"), key=self.key).digest()
            self.bits, self.count = int.from_bytes(digest, "big") | 1 << 512, self.count + 1
        self.bits, out = divmod(self.bits, n)
        return out

    def of(self, items: str) -> str:
        return items[self.below(len(items))]


def in_kind(char: str, stream: Stream) -> str:
    """Another character of the same class: digit, or letter of the same case."""
    if char.isdigit():
        return stream.of("0123456789")
    if "a" <= char.lower() <= "z":
        new = stream.of("abcdefghijklmnopqrstuvwxyz")
        return new.upper() if char.isupper() else new
    return char


# Consonants and vowels of each script, and name endings by gender.
SOUNDS = {
    "latin": ("bdfgklmnprstv", "aeiou", {"m": ("n", "rt", "ld", "k"), "f": ("a", "ia", "ine", "ella"), "n": ("", "s", "n")}),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу", {"m": ("н", "р", "й", "к"), "f": ("а", "ия", "на", "ина"), "n": ("", "в", "н")}),
    "greek": ("βγδζκλμνπρστ", "αειου", {"m": ("ς", "ων", "ης", "ος"), "f": ("α", "η", "ια", "ω"), "n": ("", "ς", "ου")}),
}


def script(text: str) -> str:
    if any("Ѐ" <= c <= "ӿ" for c in text):
        return "cyrillic"
    return "greek" if any("Ͱ" <= c <= "Ͽ" for c in text) else "latin"


@lru_cache(1 << 12)
def surrogate(key: str, kind: str, value: str, attempt: int) -> str:
    """The replacement of a looked-up value, without its formatting; later attempts draw others."""
    s = Stream(key, kind, value, attempt)
    if kind == "email":
        local, _, domain = value.partition("@")
        labels = domain.split(".")
        new = "".join(in_kind(c, s) for c in local)
        return f"{new}@{'.'.join(''.join(in_kind(c, s) for c in label) for label in labels[:-1])}.{labels[-1]}"
    if kind == "ip":
        ranges = {1: (0, 10), 2: (10, 90), 3: (100, 156)}
        return ".".join(str(low + s.below(n)) for low, n in (ranges[len(p)] for p in value.split(".")))
    if kind == "card":
        body = value[0] + "".join(in_kind(c, s) for c in value[1:-1])
        valid = luhn(value) % 10 == 0
        return body + (str(-luhn(body + "0") % 10) if valid else in_kind(value[-1], s))
    if kind == "ssn":
        return f"{(n := 1 + s.below(898)) + (n >= 666):03d}{1 + s.below(99):02d}{1 + s.below(9999):04d}"
    if kind == "phone":
        country = len(value) - 10 if len(value) > 10 else 0  # the country stays
        return value[:country] + str(2 + s.below(8)) + "".join(in_kind(c, s) for c in value[country + 1 :])
    if kind == "iban":
        body = "".join(in_kind(c, s) for c in value[4:])
        check = 98 - int("".join(str(int(c, 36)) for c in f"{body}{value[:2]}00")) % 97
        return f"{value[:2]}{check:02d}{body}"
    if kind == "secret":
        start = 4 if AWS.fullmatch(value) else 0
        if HEX.fullmatch(value):
            return "".join(s.of("0123456789abcdef") for _ in value)
        return value[:start] + "".join(in_kind(c, s) for c in value[start:])
    consonants, vowels, endings = SOUNDS[script(value)]
    gender = kind[-1] if kind.startswith("given") else "n"
    # every eight attempts the name gets a syllable more, so names never run out
    syllables = max(2, min(3, len(value) // 3)) + attempt // 8
    name = "".join(s.of(consonants) + s.of(vowels) for _ in range(syllables))
    end = endings[gender][s.below(len(endings[gender]))]
    name = (name[:-1] if end and end[0] in vowels else name) + end
    return name.upper() if value.isupper() else name.capitalize()


def shaped(new: str, old: str, kind: str) -> str:
    """A surrogate with the spacing, brackets and letter case of the mention."""
    if kind in ("card", "ssn", "phone", "iban"):
        chars = iter(new)
        return "".join(next(chars) if c.isalnum() else c for c in old)
    if (kind == "email" or kind == "surname" or kind.startswith("given_")) and old.isupper():
        return new.upper()
    return new


def replaced(text: str | None, key: str, attempts: dict[tuple[str, str], int]) -> tuple[str | None, int]:
    """The text with surrogates, and how many mentions were replaced. A null text stays null."""
    if not text:
        return text, 0
    out, at, found = [], 0, mentions(text)
    for m in found:
        new = surrogate(key, m.kind, m.value, attempts.get((m.kind, m.value), 0))
        out += [text[at : m.start], shaped(new, text[m.start : m.end], m.kind)]
        at = m.end
    return "".join([*out, text[at:]]), len(found)


def entities(documents: DataFrame, text: str) -> DataFrame:
    """Each text's distinct entities: columns of the text's key (k1, k2), kind, value."""
    ready(documents)

    @F.pandas_udf("array<struct<kind:string,value:string>>")
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([list({(m.kind, m.value) for m in mentions(t)}) for t in batch], dtype=object)

    # said not to be deterministic, or Spark finds the entities twice: first to leave out texts without any
    rows = documents.select(*text_key(text), found.asNondeterministic()(text).alias("e"))
    return rows.select("__k1", "__k2", F.explode("e").alias("e")).select("__k1", "__k2", "e.kind", "e.value")


def text_key(text: str):
    return F.xxhash64(text).alias("__k1"), F.xxhash64(F.lit(9), F.reverse(text)).alias("__k2")


def drawn_again(found: DataFrame, key: str) -> tuple[DataFrame, list[str]]:
    """Entities whose first surrogate is not theirs alone: kind, value, attempt. Also the paths to discard."""
    spark = ready(found)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["surrogate"] = [surrogate(key, *x) for x in zip(b["kind"], b["value"], b["attempt"], strict=True)]
            yield b

    schema = "kind string, value string, attempt int, family string, surrogate string"
    family = F.split("kind", "_")[0]  # given names of both genders must differ from one another
    table = store(
        found.groupBy("kind", "value").agg(F.lit(0).alias("attempt")).withColumn("family", family).mapInPandas(draw, schema),
        "pii-entities",
    )
    paths = [table.path]
    while True:
        drawn = table.rows
        # of those that share a surrogate the smallest keeps it, unless it is a real entity
        owner = drawn.groupBy("family", "surrogate").agg(
            F.min(F.struct("kind", "value")).alias("owner"), F.count("*").alias("n")
        )
        real = drawn.select("family", F.col("value").alias("surrogate"), F.lit(True).alias("real")).distinct()
        clash = owner.join(real, ["family", "surrogate"], "left").where((F.col("n") > 1) | F.col("real").isNotNull())
        clash = store(clash, "pii-clashes")
        paths.append(clash.path)
        if clash.rows.isEmpty():
            return drawn.where("attempt > 0").select("kind", "value", "attempt"), paths
        joined = drawn.join(clash.rows, ["family", "surrogate"], "left")
        again = F.col("n").isNotNull() & (F.col("real").isNotNull() | (F.col("owner") != F.struct("kind", "value")))
        moved = joined.select("kind", "value", (F.col("attempt") + again.cast("int")).alias("attempt"), "family")
        table = store(moved.mapInPandas(draw, schema), "pii-entities")
        paths.append(table.path)


def with_surrogates(documents: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """The documents with personal data replaced in ``text``; ``count`` names a column for how many mentions were.

    Null and empty texts stay as they are. Repeated rows stay, and agree. Other columns pass through.
    """
    spark = ready(documents)
    found = store(entities(documents, text), "pii-mentions")
    again, paths = drawn_again(found.rows, key)
    # texts that hold an entity drawn again, with what they need; a stored table, so Spark sees how small it is
    needs = found.rows.join(again, ["kind", "value"]).groupBy("__k1", "__k2")
    needs = store(needs.agg(F.collect_set(F.struct("kind", "value", "attempt")).alias("__needs")), "pii-needs")
    for path in [found.path, *paths]:
        discard(spark, path)

    @F.pandas_udf("struct<text:string,n:int>")
    def replace(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, attempts in batches:
            rows = [
                replaced(t, key, {(x["kind"], x["value"]): x["attempt"] for x in (a if a is not None else ())})
                for t, a in zip(texts, attempts, strict=True)
            ]
            yield pd.DataFrame({"text": [r[0] for r in rows], "n": [r[1] for r in rows]}).astype({"n": "int32"})

    k1, k2 = text_key(text)
    own = documents.withColumn("__own1", k1).withColumn("__own2", k2)
    if needs.rows.isEmpty():
        joined = own.withColumn("__needs", F.lit(None).cast(needs.rows.schema["__needs"].dataType))
    else:
        joined = own.join(needs.rows, (F.col("__own1") == F.col("__k1")) & (F.col("__own2") == F.col("__k2")), "left")
    joined = joined.withColumn("__new", replace(text, "__needs"))
    columns = [F.col("__new.text").alias(c) if c == text else F.col(f"`{c}`") for c in documents.columns]
    return joined.select(*columns, *([F.col("__new.n").alias(count)] if count else []))
