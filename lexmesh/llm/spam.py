"""Keyword-stuffed and link-list pages (problem 10).

Pages are described by content and link features. Rules of thumb label the clear
ones; bagged decision trees learn from these and judge every page; the spam rate of
a page's host then moves the judgement of doubtful pages.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmesh.operators.skewjoin import join_unique
from lexmesh.storage import materialize

#: Function words of English, French, German and Spanish.
FUNCTION_WORDS = frozenset(
    """a about above after all also am among an and any are as at be because been before below between both but by can could did do does during each either else every for from further had has have he her his how
    if in into is it its may more most my no not nothing of off on only or other our out over she should since so some such than that the their
    then there these they this those through to too under unless until up upon us was we were what when where which while who whoever whose
    will with without would you your
    au aucun aux avec avons car ce cela ces cette chez comme comment dans de depuis des deux donc du elle elles en est et
    eux il ils je la le les leur leurs lorsque lui mais même ne ni nos notre nous on ont ou où par pas plus pour quand que
    quel quelle qui sa sans sauf se selon ses si son sont sous sur tous tout toute très un une vers vos votre y été être
    aber alle als also am an auch auf aus bei beim bis da dann das dass daß dem den denen der des dessen dort die dies diese
    dieser dieses doch durch ein eine einem einen einer eines er es für gegen hat haben ich ihr im in ist jede jeder
    jedoch kann kaum kein keine man mit nach nicht noch nur ob obwohl oder ohne sein seine seit sich sie sind sofern
    sondern um und uns unter vom von vor wann war warum was weil welche wenn wer werden wie wir wird wo wobei wurde zu
    zum zur zwischen über
    al algo ante antes aquel aunque bajo cada como con contra cual cuando cuándo de del desde donde dónde el ella ellos
    en entre era es esa ese eso esta este esto está fue ha hacia han hasta la las le les lo los mientras muy más ni nos
    o otro para pero por porque pues que quien qué salvo se según ser si sin sobre son su sus también tan todo tras un una
    uno unos ya y e cómo""".split()
)
#: Words of offers in the same languages.
OFFER_WORDS = frozenset(
    """best buy cheap cheapest coupon deal deals discount free online order price prices sale shipping shop top
    acheter cher gratuit ligne livraison meilleur pas prix promo remise soldes
    angebot beste günstig kaufen preis rabatt versand online
    barato comprar descuento envío gratis línea mejor oferta precio rebaja""".split()
)
#: Words that open a question.
QUESTION_WORDS = frozenset("how what when where which who why comment combien où pourquoi quand quel quelle wann warum was welche wer wie wo wozu cómo cuál cuándo cuánto dónde por qué quién".split())

FEATURES = (
    "function_share", "offer_share", "leet_share", "upper_share", "number_share", "link_chars", "link_lines", "poor_chars", "end_marks", "mean_words",
    "same_words", "bigram_repeats", "top_bigram", "hash_share", "separator_share", "question_lines", "run_length",
)

_LINK = re.compile(r"\[/?(?:url|link|img)[^\]]*\]|</?\w[^>]*>|(?:https?://|www\.)[^\s<>\]]+", re.I)
_NOTE = re.compile(r"\s*\[\d+\]\s+(?=\S)")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")
_MIXED = re.compile(r"(?=[^\W_]*\d)(?=[^\W_]*[^\W\d_])[^\W_]{3,}")
_UNIT_WORDS = 40


def _units(text: str) -> Iterator[str]:
    """Lines, long ones in runs of 40 words."""
    for line in text.split("\n"):
        if line.strip():
            words = line.split()
            for i in range(0, len(words), _UNIT_WORDS):
                yield " ".join(words[i : i + _UNIT_WORDS])


#: A page is in a language of no list if fewer of its words are function words and fewer of its word pairs recur.
FOREIGN_FUNCTION, FOREIGN_REPEATS = 0.08, 0.1
#: Letters of scripts without blanks between words; each counts as a word.
_UNSPACED = re.compile(r"[\u0e00-\u0eff\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")
_LINKISH = re.compile(r"[\[<]|https?://|www\.", re.I)


def page_features(text: str | None) -> list[float]:
    """FEATURES of one page over its whole text; null, empty and blank texts give zeros.

    A page in a language of no word list, told by few function words without recurring
    word pairs, is judged by its words of up to three letters instead, which prose of any
    language has.
    """
    text = text or ""
    units: list[tuple] = []
    words_all: list[str] = []
    function = single = offer = leet = upper = numbers = 0
    longest = run = 0
    for unit in _units(text):
        bare, links = unit, 0
        if _LINKISH.search(unit):
            links = sum(len(m) for m in _LINK.findall(unit))
            bare = _LINK.sub(" ", unit)
        note = unit.lstrip()[:1] == "[" and _NOTE.match(unit) is not None
        if not bare.isascii():
            bare = _UNSPACED.sub(r"\g<0> ", bare)
        words = _WORD.findall(bare)
        low = [w.lower() for w in words]
        plain = [w for w in low if not w.isdigit()]
        numbers += len(low) - len(plain)
        f = o = m = short = 0
        for w in plain:
            if w in FUNCTION_WORDS or len(w) == 1 or not w.isalpha() and ("'" in w or "’" in w) and re.split("['’]", w)[0] + "e" in FUNCTION_WORDS:
                f += 1
                if run > longest:
                    longest = run
                run = 0
            else:
                run += 1
            if w in OFFER_WORDS:
                o += 1
            if len(w) <= 3:
                short += 1
                single += len(w) == 1
            elif not w.isalpha() and _MIXED.fullmatch(w):
                m += 1
        m += sum(1 for w in plain if len(w) == 3 and not w.isalpha() and _MIXED.fullmatch(w))
        upper += sum(len(w) > 2 and w.isupper() for w in words)
        function, offer, leet = function + f, offer + o, leet + m
        words_all += plain
        question = bool(plain) and plain[0] in QUESTION_WORDS and not unit.rstrip().endswith((".", "?", "!", ":")) and len(plain) <= 9
        units.append((len(unit), links, note and links > 0, len(plain), f, o, m, short, question))
    content = [w for w in words_all if w not in FUNCTION_WORDS]
    pairs = Counter(zip(content, content[1:], strict=False))
    total = max(len(content) - 1, 1)
    k = max(len(words_all), 1)
    repeats = sum(v for v in pairs.values() if v > 2) / total
    foreign = (function - single) / k < FOREIGN_FUNCTION and repeats < FOREIGN_REPEATS
    chars = poor = linked = 0.0
    link_units = questions = 0
    for n, links, reference, size, f, o, m, short, question in units:
        if reference:  # a reference under a text
            continue
        chars += n
        linked += links
        link_units += links > 0
        questions += question
        share = (short if foreign else f) / max(size, 1)
        if not size or share < 0.12 or question or m / size > 0.3 or (o / size > 0.08 and share < 0.28):
            poor += n
    c = max(chars, 1.0)
    marks, hashes, seps = (sum(text.count(x) for x in of) for of in (".?!", "#", "|*·»;,/>-"))
    # the chance that two content words of the page are equal: independent of length, unlike type-token ratios
    same = sum(v * (v - 1) for v in Counter(content).values()) / max(len(content) * (len(content) - 1), 1)
    return [
        function / k, offer / k, leet / k, upper / k, numbers / (k + numbers), linked / c, link_units / max(len(units), 1), poor / c, marks / k, k / max(marks, 1) / 40,
        same, repeats, max(pairs.values(), default=0) / total, hashes / k, seps / k, questions / max(len(units), 1), min(max(longest, run), 60) / 60,
    ]


def with_features(documents: DataFrame) -> DataFrame:
    """(doc_id, host, features...): one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [page_features(t) for t in batch.column("text").to_pylist()]
            cols = [pa.array(c, pa.float64()) for c in (zip(*rows, strict=True) if rows else [[] for _ in FEATURES])]
            yield pa.record_batch([batch.column("doc_id"), batch.column("host"), *cols], names=["doc_id", "host", *FEATURES])

    page = documents.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.trim("source"), F.lit("")).alias("host"), "text")
    return page.mapInArrow(run, "doc_id long, host string, " + ", ".join(f"{f} double" for f in FEATURES))


def weak_label(df: DataFrame) -> DataFrame:
    """label 1 for clear spam, 0 for clear text, null for the rest."""
    offers = F.col("offer_share")
    spam = (F.col("poor_chars") > 0.6) | ((F.col("same_words") > 0.05) & (offers > 0.1))
    text = (F.col("poor_chars") < 0.3) & ~((F.col("same_words") > 0.05) & (offers > 0.05))
    return df.withColumn("label", F.when(spam, 1.0).when(text, 0.0))


def spam_scores(documents: DataFrame, train_rows: int = 200_000, trees: int = 25, depth: int = 6, host_weight: float = 0.25, host_prior: float = 50.0, seed: int = 7) -> DataFrame:
    """(doc_id, host, page_score, host_rate, score): the smoothed probability that a page is spam.

    The trees are fitted on at most about ``train_rows`` weakly labelled pages, taken
    by a hash of doc_id; they judge every page. A host's rate is the mean judgement of
    its pages, drawn to the overall mean by ``host_prior`` pages; the log-odds of a
    page move by ``host_weight`` times the difference of its host's log-odds to the
    overall ones. Pages without source share one nameless host. Without labelled pages
    of both kinds the share of poor characters is the judgement. Repeated doc_ids are
    judged row by row.
    """
    pages = materialize(with_features(documents))
    labelled = weak_label(pages).filter("label IS NOT NULL")
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="x")
    if len(counts) == 2:
        keep = min(1.0, train_rows / sum(counts.values()))
        chosen = labelled.filter(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000)) < int(keep * 1_000_000))
        fit = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, featureSubsetStrategy="all", subsamplingRate=0.7, seed=seed, maxMemoryInMB=64)
        model = fit.fit(vector.transform(chosen).select("x", "label"))
        judged = model.transform(vector.transform(pages)).select("doc_id", "host", vector_to_array("probability")[1].alias("page_score"))
    else:
        judged = pages.select("doc_id", "host", F.col("poor_chars").alias("page_score"))
    judged = materialize(judged)
    mean = judged.agg(F.avg("page_score")).first()[0] or 0.0
    logit = lambda p: F.log((p + 1e-3) / (1 - p + 1e-3))
    rates = judged.groupBy("host").agg(((F.sum("page_score") + host_prior * mean) / (F.count(F.lit(1)) + host_prior)).alias("host_rate"))
    both = join_unique(judged, rates, "host")
    odds = logit(F.col("page_score")) + host_weight * (logit(F.col("host_rate")) - logit(F.lit(mean)))
    return both.select("doc_id", "host", "page_score", "host_rate", (1 / (1 + F.exp(-odds))).alias("score"))


def spam_pages(documents: DataFrame, threshold: float = 0.5, **how) -> DataFrame:
    """(doc_id) of the pages whose smoothed score exceeds the threshold."""
    return spam_scores(documents, **how).filter(F.col("score") > threshold).select("doc_id").distinct()
