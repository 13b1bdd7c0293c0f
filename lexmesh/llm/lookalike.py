"""Visually identical text with different characters (problem 5).

Code points and short strings that display alike form classes by union-find:
compatibility widths and ligatures, blanks, invisible characters, letters of
different scripts. In each language the member used most stands for its class, and
an automaton over all members rewrites texts greedily, longest match first.
"""

from __future__ import annotations

import string
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmesh.functions.keys import strip_key

#: Letters of different scripts with one shape, a class per group; the published table of
#: confusable characters adds further scripts where the session can read it.
SAME_SHAPE = """
AΑАᎪ BΒВᏴ CСϹⅭ DⅮᎠ EΕЕᎬ FϜ GԌ HΗНᎻ IΙІӀⅠ JЈͿ KΚКK LⅬᏞ MΜМϺⅯ NΝ OΟОՕ PΡРᏢ QԚ SЅՏ TΤТᎢ VⅤѴ WԜ XΧХⅩ YΥҮ ZΖᏃ
aаɑ cсϲⅽ dԁⅾ eе gɡց hһհ iіⅰ jјϳ lⅼ mⅿ nո oоοօ pрⲣ qԛ sѕ uսʋ vνѵⅴ wԝ xхⅹ yу
ГΓ ПΠ ФΦ ЛΛ κкĸ зɜ эɛ
""".split()
#: Hyphens of one shape, with the one of ASCII first.
HYPHENS = "-‐‑"
#: Marks that are blank though Unicode doesn't class them as invisible or space.
BLANK_LETTERS = {"ᅟ": "", "ᅠ": "", "ㅤ": " ", "ﾠ": " ", "⠀": " ", "͏": "", "឴": "", "឵": "", "᠎": ""}
#: Kinds of compatibility forms that differ in width, font or joining only.
WIDTH_TAGS = {"<wide>", "<narrow>", "<noBreak>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>"}


def _ligature_or_numeral(ch: str) -> bool:
    name = unicodedata.name(ch, "")
    return " LIGATURE " in name or "ROMAN NUMERAL" in name or " DIGRAPH " in name or name.startswith("LATIN SMALL LETTER DZ")


def equal_forms(ch: str) -> str | None:
    """What a code point displays like by its Unicode properties, or None if only like itself."""
    if ch in BLANK_LETTERS:
        return BLANK_LETTERS[ch]
    kind = unicodedata.category(ch)
    if kind == "Zs" or ch in "\t\n\r\x0b\x0c\x85  ":
        return " " if ch != " " else None
    if kind in ("Cf", "Cc") or unicodedata.name(ch, "").startswith("VARIATION SELECTOR"):
        return ""
    tag, _, rest = unicodedata.decomposition(ch).partition(" ")
    if tag in WIDTH_TAGS or tag == "<compat>" and _ligature_or_numeral(ch):
        return unicodedata.normalize("NFD", "".join(chr(int(x, 16)) for x in rest.split()))
    return None


class Classes:
    """Union-find over strings and code points."""

    def __init__(self) -> None:
        self.up: dict[str, str] = {}

    def find(self, x: str) -> str:
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def tie(self, x: str, y: str) -> None:
        a, b = self.find(x), self.find(y)
        if a != b:
            self.up[max(a, b, key=lambda s: (len(s) != 1, s))] = min(a, b, key=lambda s: (len(s) != 1, s))

    def members(self) -> list[list[str]]:
        out = defaultdict(list)
        for x in self.up:
            out[self.find(x)].append(x)
        return [sorted(v) for v in out.values() if len(v) > 1]


def prototypes(spark: SparkSession, code_points: Iterable[str]) -> dict[str, str]:
    """Each letter to the string it may be taken for by Unicode's table of confusable characters, read by the driver's JVM."""
    letters = sorted(c for c in code_points if unicodedata.category(c)[0] == "L")
    mark = "\ue000"
    checker = spark.sparkContext._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    return dict(zip(letters, checker.getSkeleton(mark.join(letters)).split(mark), strict=True)) if letters else {}


def _script(ch: str) -> str:
    return unicodedata.name(ch, "").partition(" ")[0]


def cross_script_ties(confusable: dict[str, str], classes: Classes) -> None:
    """Tie letters of one case that are taken for the same string, if their class has no letter of that script yet.

    Letters of one script are told apart by its readers however alike they are, so a
    class never gains a second one of a script.
    """
    groups: dict[tuple[str, bool, bool], list[str]] = defaultdict(list)
    for ch, like in confusable.items():
        if unicodedata.normalize("NFD", ch) == ch:
            groups[like, ch.isupper(), ch.islower()].append(ch)
    scripts = {root: {_script(m) for m in ms if len(m) == 1} for ms in classes.members() for root in [classes.find(ms[0])]}
    for (_, upper, lower), members in sorted(groups.items()):
        if not (upper or lower):
            continue
        first = min(members, key=lambda c: (not c.isascii(), c))
        for ch in sorted(members):
            a, b = classes.find(first), classes.find(ch)
            have, more = scripts.get(a, {_script(first)}), scripts.get(b, {_script(ch)})
            if a != b and not have & more:
                classes.tie(a, b)
                scripts[classes.find(a)] = have | more


def look_alike_classes(code_points: Iterable[str], confusable: dict[str, str] | None = None) -> list[list[str]]:
    """Classes of strings that display alike, for the code points that occur; ``confusable`` as from ``prototypes``."""
    classes = Classes()
    for group in SAME_SHAPE:
        for ch in group[1:]:
            classes.tie(group[0], unicodedata.normalize("NFD", ch))
    for ch in HYPHENS[1:]:
        classes.tie(HYPHENS[0], ch)
    for ch in set(code_points):
        like = equal_forms(ch)
        if like is not None and like != ch:
            classes.tie(ch, like)
    cross_script_ties(confusable or {}, classes)
    return classes.members()


def representatives(classes: list[list[str]], counts: Counter) -> dict[str, str]:
    """Each member to its class's representative.

    Invisible classes vanish and blanks become a space. A class with a string of several
    code points is spelled out in it, since its characters have classes of their own.
    Else the most frequent member stands, ties going to the smallest.
    """
    out = {}
    for members in classes:
        spelled = [m for m in members if len(m) > 1]
        if "" in members:
            best = ""
        elif " " in members:
            best = " "
        elif spelled:
            best = max(spelled, key=lambda m: (min(counts[c] for c in m), m))
        else:
            best = min(members, key=lambda m: (-counts[m], m))
        out.update({m: best for m in members if m and m != best})
    for m, best in out.items():  # spelled-out strings are rewritten in their parts
        if len(best) > 1:
            out[m] = "".join(out.get(c, c) if len(out.get(c, c)) < 2 else c for c in best)
    return out


def automaton(rewrites: dict[str, str]):
    import ahocorasick

    auto = ahocorasick.Automaton()
    for pattern, best in rewrites.items():
        auto.add_word(pattern, (len(pattern), best))
    if rewrites:
        auto.make_automaton()
    return auto if rewrites else None


def rewrite(text: str, auto) -> str:
    """Canonical decomposition, greedy rewriting, composition; runs of blanks become one, at the ends none."""
    text = unicodedata.normalize("NFD", text)
    if auto is not None:
        parts, at = [], 0
        for end, (size, best) in auto.iter_long(text):
            parts += [text[at : end + 1 - size], best]
            at = end + 1
        text = "".join([*parts, text[at:]])
        text = unicodedata.normalize("NFD", text)
    return unicodedata.normalize("NFC", " ".join(x for x in text.split(" ") if x))



class PlainForms:
    """Forms for comparing texts without corpus counts: the smallest member of a class stands.

    The automaton knows the code points met so far and is built anew only when others
    turn up, so a worker builds it a bounded number of times. What stands for a class
    does not depend on the texts seen before.
    """

    def __init__(self) -> None:
        self.known: set[str] = set()
        self.auto = None

    def of(self, text: str | None) -> str:
        if not text:
            return ""
        if text.isascii() and text.isprintable():
            return " ".join(text.split())
        marks = set(unicodedata.normalize("NFD", text))
        if not marks <= self.known:
            self.known |= marks
            self.auto = automaton(representatives(look_alike_classes(self.known), Counter()))
        return rewrite(text, self.auto)


_FORMS = PlainForms()


def plain_form(text: str | None) -> str:
    """A form for comparing labels of any language; one automaton serves a whole worker."""
    return _FORMS.of(text)


def meet_marks(texts: Iterable[str | None]) -> None:
    """Have ``plain_form`` know all marks of these texts at once, so that its automaton is built once for them."""
    _FORMS.of("".join({c for t in texts if t and not t.isascii() for c in t}))


def primary_language(language: Column) -> Column:
    """The first subtag in lower case; '' for null."""
    return F.coalesce(F.lower(F.regexp_extract(F.trim(language), r"^([^-_]*)", 1)), F.lit(""))


def character_counts(labels: DataFrame) -> DataFrame:
    """(lang, ch, n): how often each code point of decomposed values occurs in each language, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, value in zip(batch.column("lang").to_pylist(), batch.column("value").to_pylist(), strict=True):
                counts[lang].update(unicodedata.normalize("NFD", value))
        rows = [(lang, ch, n) for lang, of in counts.items() for ch, n in of.items()]
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], names=["lang", "ch", "n"])

    return labels.select("lang", "value").mapInArrow(run, "lang string, ch string, n long").groupBy("lang", "ch").agg(F.sum("n").alias("n"))


def canonical_labels(labels: DataFrame) -> DataFrame:
    """(id, resource, lang, value, canonical), distinct rows of labels with a value.

    ids and resources come without surrounding blanks; lang is the primary language.
    Null ids, resources or values name nothing. Texts that show nothing have the
    canonical form ''. Whole values are rewritten, however long.
    """
    rows = labels.select(strip_key("id").alias("id"), strip_key("resource").alias("resource"), primary_language(F.col("language")).alias("lang"), "value").dropna().distinct()
    # bounded by Unicode: one row per language and code point
    by_lang: dict[str, Counter] = defaultdict(Counter)
    for r in character_counts(labels.select(primary_language(F.col("language")).alias("lang"), "value").dropna()).collect():
        by_lang[r["lang"]][r["ch"]] = r["n"]
    known = {ch for of in by_lang.values() for ch in of}
    classes = look_alike_classes(known, prototypes(labels.sparkSession, known | set(string.ascii_letters)))
    rewrites = {lang: representatives(classes, of) for lang, of in by_lang.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        autos: dict[str, object] = {}
        for batch in batches:
            out = []
            for lang, value in zip(batch.column("lang").to_pylist(), batch.column("value").to_pylist(), strict=True):
                if lang not in autos:
                    autos[lang] = automaton(rewrites.get(lang, {}))
                out.append(rewrite(value, autos[lang]))
            yield pa.record_batch([*batch.columns, pa.array(out, pa.string())], names=["id", "resource", "lang", "value", "canonical"])

    return rows.mapInArrow(run, "id string, resource string, lang string, value string, canonical string")


def alike_members(canonical: DataFrame) -> DataFrame:
    """(label, standing, labels): labels that display like another of their resource and language, each with the smallest
    id of its class, which stands for it, and the number of labels there. One row a label and class, whatever its size."""
    key = ["resource", "lang", "canonical"]
    classes = canonical.groupBy(*key).agg(F.min("id").alias("standing"), F.count_distinct("id").alias("labels"), F.min("value").alias("_a"), F.max("value").alias("_b")).filter("_a <> _b AND labels > 1")
    return canonical.select(*key, F.col("id").alias("label")).distinct().join(classes, key).select("label", "standing", "labels").distinct()


def alike_pairs(canonical: DataFrame, group_rows: int = 2_000) -> DataFrame:
    """(label_1, label_2): different labels of a resource and language that display alike but aren't the same characters.

    Groups of more than ``group_rows`` labels are split: each part of the left side
    meets the whole group, so no task holds all pairs of a large group.
    """
    key = ["resource", "lang", "canonical"]
    groups = canonical.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min("value").alias("_a"), F.max("value").alias("_b")).filter("_a <> _b")
    parts = F.ceil(F.col("_n") / group_rows).cast("int")
    both = canonical.join(groups.select(*key, parts.alias("_parts")), key)
    left = both.select(*key, F.pmod(F.xxhash64("id", "value"), F.col("_parts")).cast("int").alias("_part"), F.col("id").alias("label_1"), F.col("value").alias("_v1"))
    right = both.select(*key, F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"), F.col("id").alias("label_2"), F.col("value").alias("_v2"))
    return left.join(right, [*key, "_part"]).filter("label_1 < label_2 AND _v1 <> _v2").select("label_1", "label_2").distinct()
