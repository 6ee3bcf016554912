"""License statements in texts, found by ordered signature rules and built-in functions only.

A text becomes a line of words: A to Z in lower case, words of digits, a to z and letters beyond ASCII, one
space between them. A rule has a keyword, which is the first word of what it matches, words that it needs,
a pattern, a level and a label. Rules run where their keyword stands, over the next words (``WIDTH``), and
only if the words they need are among them; texts without any of ``STEMS`` are not looked at.

All rules are tried at all places. A find is put aside if another one covers its words and has a better
(smaller) level, or the same level and more words, or the same words and an earlier rule. Rules without a
label put finds aside and add no label.

A null text counts as empty; a text without finds has an empty list. Repeated rows are rows. A row stays one
row and nothing is shuffled, so no key can be hot. A find is compared with those of the last ``WIDTH`` words
only, so time grows with the length of a text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases that are labelled wherever they stand, covered or not.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Names of licenses as lines of words. The first word is the keyword of the name; versions fill {}.
NAMES = {
    "mit": ["mit license", "mit licence", "mit x11 license", "mit style license", "expat license", "x11 license", "mit open source license"],
    "apache": ["apache license", "apache software license", "apache licence"],
    "apache-{}": ["apache license version {}", "apache license {}", "apache software license version {}", "apache {} license"],
    "gpl": ["gnu general public license", "general public license", "gnu gpl", "gpl license", "gnu general public licence"],
    "gpl-{}": ["gnu general public license version {}", "gnu general public license v{}", "general public license version {}",
               "gnu gpl version {}", "gnu gplv{}", "gplv{}", "gpl v{}", "gpl {}"],
    "lgpl": ["gnu lesser general public license", "lesser general public license", "gnu library general public license", "gnu lgpl"],
    "lgpl-{}": ["gnu lesser general public license version {}", "gnu lesser general public license v{}", "lgplv{}", "lgpl v{}", "lgpl {}"],
    "agpl": ["gnu affero general public license", "affero general public license", "gnu agpl"],
    "agpl-{}": ["gnu affero general public license version {}", "gnu affero general public license v{}", "agplv{}", "agpl v{}", "agpl {}"],
    "bsd": ["bsd license", "bsd licence", "bsd style license"],
    "bsd-{}-clause": ["bsd {} clause license", "{} clause bsd license", "bsd {} clause", "{} clause bsd"],
    "mpl-{}": ["mozilla public license version {}", "mozilla public license v {}", "mozilla public license {}"],
    "epl-{}": ["eclipse public license version {}", "eclipse public license v {}", "eclipse public license {}"],
    "cddl-{}": ["common development and distribution license version {}", "common development and distribution license {}"],
    "eupl-{}": ["european union public licence version {}", "european union public licence v {}", "european union public license {}"],
    "artistic-{}": ["artistic license {}", "artistic license version {}"],
    "gfdl-{}": ["gnu free documentation license version {}", "gfdl license {}"],
    "cc-by-{}": ["creative commons attribution {}", "cc by {}"],
    "cc-by-sa-{}": ["creative commons attribution sharealike {}", "creative commons attribution share alike {}", "cc by sa {}"],
    "cc-by-nc-{}": ["creative commons attribution noncommercial {}", "creative commons attribution non commercial {}", "cc by nc {}"],
    "cc-by-nd-{}": ["creative commons attribution noderivatives {}", "creative commons attribution noderivs {}", "cc by nd {}"],
    "cc-by-nc-sa-{}": ["creative commons attribution noncommercial sharealike {}", "cc by nc sa {}"],
    "cc-by-nc-nd-{}": ["creative commons attribution noncommercial noderivatives {}", "cc by nc nd {}"],
    "cc": ["creative commons license", "creative commons licence"],
    "cc0": ["cc0 1 0", "creative commons zero", "cc0 license"],
    "isc": ["isc license", "internet systems consortium license"],
    "zlib": ["zlib license", "zlib libpng license"],
    "boost": ["boost software license"],
    "unlicense": ["unlicense", "the unlicense"],
    "wtfpl": ["wtfpl", "do what the fuck you want to public license"],
    "odbl": ["open database license", "odbl license"],
    "ofl": ["sil open font license", "open font license"],
    "psf": ["python software foundation license", "psf license"],
    "ms-pl": ["microsoft public license", "ms pl license"],
    "proprietary": ["proprietary license", "commercial license", "end user license agreement"],
}
VERSIONS = {
    "apache-{}": ("1.0", "1.1", "2.0"), "gpl-{}": ("1.0", "2.0", "3.0"), "lgpl-{}": ("2.0", "2.1", "3.0"), "agpl-{}": ("1.0", "3.0"),
    "bsd-{}-clause": ("0", "2", "3", "4"), "mpl-{}": ("1.0", "1.1", "2.0"), "epl-{}": ("1.0", "2.0"), "cddl-{}": ("1.0", "1.1"),
    "eupl-{}": ("1.1", "1.2"), "artistic-{}": ("1.0", "2.0"), "gfdl-{}": ("1.1", "1.2", "1.3"),
}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
GRANTS = ("licensed", "released", "distributed", "available", "published", "provided", "covered", "offered")
UNDER = " (?:to you )?(?:under|by|with) (?:the )?(?:terms of |terms and conditions of |conditions of )?(?:the |a |an )?"
#: The keyword of rules that begin with any word of ``GRANTS``.
GRANT_WORD = "licensed"
#: What looks like a license and is none.
OTHER = ("driver license", "drivers license", "driving license", "poetic license", "marriage license", "license plate", "licence plate")
#: Every text that a rule can match holds one of these.
STEMS = ("licen", "gpl", "spdx", "creative commons", "cc by", "cc0", "bsd", "wtfpl")

#: Levels of the rules, and how sure a find of that level makes one.
IDENTIFIER, GRANT, METADATA, NAME = 1, 2, 3, 4
SURE = {IDENTIFIER: 1.0, GRANT: 0.9, METADATA: 0.7, NAME: 0.5}
#: No rule matches more words.
WIDTH = 32
FINDS = "array<array<struct<start:int, end:int, level:int, rule:int, label:string>>>"


@dataclass(frozen=True)
class Rule:
    keyword: str
    needs: str
    pattern: str
    level: int
    label: str
    base: bool = False


def spelled(version: str) -> str:
    """A version as words; a last 0 may be left out."""
    return version.replace(".0", "(?: 0)?").replace(".", " ")


def names() -> list[tuple[str, str]]:
    """(label, pattern of a name), longer ones of a label first."""
    out = []
    for label, patterns in NAMES.items():
        versions = VERSIONS.get(label, CC_VERSIONS if label.startswith("cc-") else ("",))
        for version in versions:
            out += [(label.format(version), p.format(spelled(version))) for p in sorted(patterns, key=len, reverse=True)]
    return out


def plain_part(pattern: str) -> str:
    """The words with which a pattern begins in any case."""
    return pattern.split("(")[0].rstrip()


@cache
def rules() -> tuple[Rule, ...]:
    """All rules in their order; they match from the keyword's place on, up to a space or the end."""
    made = [Rule(p.split()[0], p, p, 0, label, True) for p, label in BASE.items()]
    known = names()
    for label in dict.fromkeys(label for label, _ in known):
        words = label.replace("-", " ").replace(".", " ")
        made.append(Rule("spdx", words, f"spdx license identifier {words}(?: only| or later)?", IDENTIFIER, label))
        made.append(Rule("opensource", words, f"opensource org licenses {words}", IDENTIFIER, label))
        made += [Rule(word, words, f"{word} {words}", METADATA, label) for word in ("license", "licence")]
    for label, name in known:
        made.append(Rule(GRANT_WORD, plain_part(name), f"(?:{'|'.join(GRANTS)}){UNDER}{name}", GRANT, label))
        made.append(Rule(plain_part(name).split()[0], plain_part(name), name, NAME, label))
    made += [Rule(p.split()[0], p, p, IDENTIFIER, "") for p in OTHER]
    return tuple(made)


def line_of_words(text: Column) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    lower = F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())
    return F.trim(F.regexp_replace(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def number_of_words(line: Column) -> Column:
    spaces = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))
    return F.when(line == "", 0).otherwise(spaces + 1).cast("long")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@cache
def _rule_map() -> str:
    """The rules of each keyword as a constant of SQL."""
    by_keyword: dict[str, list[str]] = {}
    for number, r in enumerate(rules()):
        fields = f"{number} AS rule, {_text(r.needs)} AS needs, {_text(f'^{r.pattern}(?: |$)')} AS pattern, {r.level} AS level, {_text(r.label)} AS label"
        by_keyword.setdefault(r.keyword, []).append(f"struct({fields})")
    return f"map({', '.join(f'{_text(k)}, array({", ".join(v)})' for k, v in by_keyword.items())})"


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once for a row or an element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def finds(line: Column) -> Column:
    """For each place of a keyword the finds of its rules: array<array<struct<start, end, level, rule, label>>>.

    ``start`` is the first word, from 0, and ``end`` the one behind the last.
    """
    keywords = sorted({r.keyword for r in rules()}.union(GRANTS))

    def rules_of(word: Column) -> Column:
        return F.element_at(F.expr(_rule_map()), F.when(word.isin(*GRANTS), GRANT_WORD).otherwise(word))

    def at(words: Column, i: Column) -> Column:
        def tried(window: Column) -> Column:
            fit = F.filter(
                rules_of(F.element_at(words, i)), lambda r: F.contains(window, r["needs"]) & F.rlike(window, r["pattern"])
            )
            return F.transform(fit, lambda r: found(r, F.size(F.split(F.trim(F.regexp_substr(window, r["pattern"])), " "))))

        def found(r: Column, n: Column) -> Column:
            first = i - 1
            return F.struct(first.alias("start"), (first + n).alias("end"), *[r[c].alias(c) for c in ("level", "rule", "label")])

        return let(F.array_join(F.slice(words, i, WIDTH), " "), tried)

    def places(words: Column) -> Column:
        return F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: F.element_at(words, i).isin(keywords))

    worth = reduce(lambda a, b: a | b, [F.contains(line, F.lit(s)) for s in STEMS])
    all_finds = let(F.split(line, " "), lambda words: F.transform(places(words), lambda i: at(words, i)))
    return F.when(worth, F.filter(all_finds, lambda x: F.size(x) > 0)).otherwise(F.array().cast(FINDS))


def uncovered(found: Column) -> Column:
    """The finds, in the order of their places, that no other one puts aside.

    What covers a find begins at most ``WIDTH`` words before it, so at most that many places are looked at.
    """

    def covers(y: Column, x: Column) -> Column:
        longer, better = x["end"] - x["start"] < y["end"] - y["start"], y["level"] < x["level"]
        same_level = (y["level"] == x["level"]) & (longer | (y["rule"] < x["rule"]))
        return (y["start"] <= x["start"]) & (y["end"] >= x["end"]) & (better | same_level)

    def at(own: Column, place: Column) -> Column:
        first = F.greatest(place + 2 - WIDTH, F.lit(1))
        near = F.flatten(F.slice(found, first, place + 2 - first))
        return let(near, lambda ys: F.filter(own, lambda x: ~F.exists(ys, lambda y: covers(y, x))))

    return F.flatten(F.transform(found, at))


def scanned(df: DataFrame, text: str = "text", words: str = "n_words", base: str = "base", licenses: str = "licenses") -> DataFrame:
    """The rows with the number of words, the finds of the base phrases and the other finds that count."""
    line, found = "__line", "__found"
    lined = df.withColumn(line, line_of_words(F.col(text)))
    with_finds = lined.withColumn(words, number_of_words(F.col(line))).withColumn(found, finds(F.col(line))).drop(line)
    others = let(F.transform(found, lambda at: F.filter(at, lambda x: x["level"] > 0)), uncovered)
    return with_finds.select(
        "*",
        F.filter(F.flatten(found), lambda x: x["level"] == 0).alias(base),
        F.filter(others, lambda x: x["label"] != "").alias(licenses),
    ).drop(found)


def labels_of(*found: str) -> Column:
    """The distinct labels of finds, sorted, with commas between them."""
    all_labels = F.concat(*[F.transform(f, lambda x: x["label"]) for f in found])
    return F.array_join(F.sort_array(F.array_distinct(all_labels)), ",")


def sureness(found: str) -> Column:
    """From 0, without finds, to 1: that of the best level found."""
    levels = F.transform(found, lambda x: reduce(lambda c, ls: c.when(x["level"] == ls[0], ls[1]), SURE.items(), F))
    return F.coalesce(F.array_max(levels), F.lit(0.0))
