"""Problem 10: keyword-stuffed and link-list pages.

A page is read once into two views that share no column. The evidence view (links, tags, prices,
list items, prose, echoed phrases, numbers) is what weak labellers vote on; where they disagree or
none is sure, a page stays unlabelled. Bagged decision trees see the other view only (function
words, repetition, line shape, punctuation, share of characters in links and markup, compressibility), are
trained on a bounded sample of the labelled pages and decide on every page, labelled or not. Page predictions
are then smoothed by the spam rate of the page's host: by Bayes' rule the odds of spam are multiplied
by the odds of the host's other pages against those of all pages.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.common import lookup_join, materialize, norm

#: Most labelled pages of each class that the trees are trained on.
SAMPLE = 20_000
#: What weak labellers see: words (links, tags and numbers included), numbers of links, tags,
#: prices, list items and numerals, words in links, lists, prose and echoed phrases, and words said before.
EVIDENCE = ("size", "links", "tags", "prices", "items", "numbers", "linked", "listed", "prose", "echo", "again")
#: What the trees see.
FEATURES = ("words", "stop", "top", "variety", "repeats", "bare", "line_words", "commas", "stops", "marks", "digits", "hidden", "packed")
#: Frequent function words of the corpus languages. Fixed values.
STOPWORDS = (
    "the a an of and to in is it its that for on with as was by this at from but or be are not we our all there has have had were will would so no if they their which "
    "der die das und ist den dem des ein eine einen einem nicht auf mit von zu sich sind wurde waren als auch an bei aus am nur noch im für "
    "le la les un une des du de et est dans que qui pour sur au aux en par ce cette il ne pas plus avec se sont "
    "el los las una uno unos del y es por con no al lo como pero sin sobre antes"
).split()


def page_reader(words: list[str], items_least: int = 7) -> Callable[[str], tuple]:
    """A function from a text to its EVIDENCE and FEATURES, all of the text read.

    Links and hashtags count as a word each. Lines are cut at sentence ends and, where they hold no figures, at
    separators. A piece is prose if it has four words or more with function words among
    them (more of them in a piece of over 40 words); a list item if it has up to six words, few of them function words, and most of its line is
    such items; a long piece without function words is a heap of items. A prose piece echoes if it
    holds twice a word or word pair that the page's distinct pieces are full of.
    """
    import re
    import zlib
    from collections import Counter
    from itertools import chain

    href = re.compile(r"<a\b[^>]*?href\s*=[^>]*>")
    block = re.compile(r"</(?:a|li|p|div|h\d|td|tr)>|<br[^>]*>")
    element = re.compile(r"<[/!]?[a-z][^<>]*>")
    named = re.compile(r"\[([^\[\]\n]*)\]\([^()\s]+\)")
    address = re.compile(r"(?:https?://|www\.)[^\s<>\"')\]]+")
    hashtag = re.compile(r"(?<!\w)#\w+")
    price = re.compile(r"\d[.,](?:99|95|90|49|00)(?![\d.,])")
    number = re.compile(r"\d+")
    link, tag = "\x01", "\x02"
    stop = frozenset(words)
    common = stop.__contains__
    # of ASCII, punctuation to spaces, digits to 0, separators to \x1e; : = _ stay. Sentence ends are \x1f
    table = bytearray(range(256))
    for c in range(33, 127):
        if chr(c) in ",;|":
            table[c] = 0x1E
        elif not chr(c).isalnum() and chr(c) not in ":=_":
            table[c] = 32
        elif chr(c).isdigit():
            table[c] = 48
    quotes = "“”„«»‘’…–—¿¡"

    def item(w: list[str]) -> bool:
        return len(w) <= 6 and w[0] not in stop and sum(map(common, w)) <= 0.34 * len(w)

    def read(text: str) -> tuple:
        low = text.lower()
        if "<" in low:
            low = element.sub(" ", block.sub("\n", href.sub(f"\n{link} ", low)))
        if "](" in low:
            low = named.sub(f"\n{link} \\1\n", low)
        if "://" in low or "www." in low:
            low = address.sub(f" {link} ", low)
        if "#" in low:
            low = hashtag.sub(f" {tag} ", low)
        links, tags, numbers = low.count(link), low.count(tag), len(number.findall(low))
        prices = len(price.findall(low)) if numbers > 2 else 0
        plain = low
        for end in (". ", "! ", "? ", ": "):
            plain = plain.replace(end, end[0] + "\x1f")
        for between in (" - ", " / ", " > "):
            plain = plain.replace(between, ",")
        if not plain.isascii():
            for c in "•·→":
                plain = plain.replace(c, ",")
            for c in quotes:
                plain = plain.replace(c, " ")
            plain = plain.replace("\xa0", " ")
        plain = plain.encode("utf-8", "replace").translate(table, b"'").decode("utf-8")
        all_words: list[str] = []
        known: list[bool] = []
        prose: list[list[str]] = []
        size = linked = listed = items = lines = 0
        for line in plain.split("\n"):
            line_words = own_items = own_listed = 0
            for own in line.split("\x1f"):
                w = own.replace("\x1e", " ").split()
                n = held = len(w)
                if not n:
                    continue
                size += n
                figures, marked = "0" in own, link in own or tag in own
                if figures or marked:
                    w = [x for x in w if x[0] not in "0\x01\x02"]
                    n = len(w)
                flags = list(map(common, w))
                s = sum(flags)
                all_words += w
                known += flags
                line_words += n
                if marked:
                    if n >= 10 and s >= 0.15 * n:
                        prose.append(w)
                    else:
                        linked += held
                    continue
                loose = ":" in own or "=" in own
                if figures:
                    if n >= 4 and s >= 0.12 * n and not loose:
                        prose.append(w)
                    continue
                if "\x1e" in own and n > 3:
                    if s < 0.2 * n:
                        parts = [p for p in map(str.split, own.split("\x1e")) if p]
                        good = [p for p in parts if item(p)]
                        g = sum(map(len, good))
                        if (g >= 0.8 * n and s < 0.12 * n) or g == n:
                            own_items, own_listed = own_items + len(good), own_listed + g
                            continue
                elif n <= 6 and not flags[0] and s <= 0.34 * n and not loose:
                    own_items, own_listed = own_items + 1, own_listed + n
                    continue
                if n >= 4 and s >= (0.12 if n <= 40 else 0.2) * n:
                    prose.append(w)
                elif n >= 14 and s < 0.12 * n:
                    own_items, own_listed = own_items + n // 3, own_listed + n
            lines += line_words > 0
            if line_words and own_listed >= 0.8 * line_words:
                listed, items = listed + own_listed, items + own_items
        told = sum(map(len, prose))
        counts = Counter(all_words)
        top = max((c for x, c in counts.items() if x not in stop), default=0)
        echo = 0
        if top >= 4 and prose:
            distinct = list(dict.fromkeys(map(tuple, prose)))
            mass = sum(map(len, distinct))
            often, many = max(4, 0.08 * mass), max(5, 0.12 * mass)
            if top >= min(often, many):  # no word or pair is said more often than its words on the page
                pairs = Counter(chain.from_iterable(zip(x, x[1:]) for x in distinct))
                single = Counter(chain.from_iterable(distinct))
                hot: set = {p for p, c in pairs.items() if c >= often and not (p[0] in stop and p[1] in stop)}
                hot |= {x for x, c in single.items() if c >= many and x not in stop}
                for x in prose if hot else ():
                    c = Counter(x) + Counter(zip(x, x[1:]))
                    if max(c[p] for p in hot) >= 2:
                        echo += len(x)
        evidence = (size, links, tags, prices, items, numbers, linked, listed if items >= items_least else 0, told - echo, echo, len(all_words) - len(counts))
        n = len(all_words)
        whole = max(1, n)
        bare = sum(len(run) for run in bytes(known).split(b"\x01") if len(run) >= 8)
        raw = text.encode("utf-8", "replace")
        return tuple(map(float, evidence)) + (
            float(n),
            sum(known) / whole,
            top / whole,
            len(counts) / whole**0.5,
            1 - len(set(zip(all_words, all_words[1:]))) / whole,
            bare / whole,
            n / max(1, lines),
            (low.count(",") + low.count(";")) / whole,
            (low.count(".") + low.count("!") + low.count("?")) / whole,
            sum(map(low.count, '/|-:=["')) / whole,
            numbers / whole,
            1 - min(len(low), len(text)) / max(1, len(text)),
            len(zlib.compress(raw, 1)) / max(1, len(raw)),
        )

    return read


def with_views(pages: DataFrame, page_id: str, text: str, host: str) -> DataFrame:
    """page, host, EVIDENCE and FEATURES of every page with text."""
    names = (*EVIDENCE, *FEATURES)

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        read = page_reader(STOPWORDS)
        for pdf in batches:
            out = pd.DataFrame([read(t) for t in pdf["text"]], columns=list(names), dtype="float64")
            out.insert(0, "host", pdf["host"].to_numpy())
            out.insert(0, "page", pdf["page"].to_numpy())
            yield out

    narrow = pages.select(F.col(page_id).cast("bigint").alias("page"), norm(host).alias("host"), F.col(text).alias("text")).filter("page IS NOT NULL AND text IS NOT NULL")
    out = narrow.mapInPandas(run, "page bigint, host string, " + ", ".join(f"{f} double" for f in names))
    return out.withColumn("host", F.when(F.col("host") != "", F.col("host")))


def weak_label() -> Column:
    """1 spam, 0 honest, null where labellers disagree or none is sure.

    Five labellers know spam: half the words in links, half of them hashtags, lists of short items, prices in every
    few words, echoed phrases. Four know honesty: prose, figures without prices, a text
    too short to be stuffed, a single prompt.
    """
    share = lambda c: F.col(c) / F.greatest(F.col("size"), F.lit(1.0))
    bare = (F.col("links") == 0) & (F.col("tags") == 0)
    spam = [
        (share("linked") >= 0.5) & (F.col("links") >= 5),
        (share("tags") >= 0.5) & (F.col("tags") >= 6),
        share("listed") >= 0.55,
        (F.col("prices") >= 3) & (share("prices") >= 1 / 15) & (share("prose") < 0.5),
        share("echo") >= 0.55,
    ]
    honest = [
        share("prose") >= 0.55,
        (share("numbers") >= 0.12) & (share("prices") < 1 / 40) & (share("linked") < 0.2) & (share("listed") < 0.2),
        (F.col("size") < 8) & bare,
        (F.col("size") <= 30) & (F.col("items") <= 6) & (F.col("echo") == 0) & (F.col("prices") == 0) & (share("again") <= 0.3) & bare,
    ]
    votes = [F.greatest(*[v.cast("int") for v in group]) for group in (spam, honest)]
    return F.when(votes[0] > votes[1], 1.0).when(votes[1] > votes[0], 0.0)


def _log_odds(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.log(p / (1 - p))


def spam_pages(
    pages: DataFrame,
    page_id: str,
    text: str,
    host: str,
    sample: int = SAMPLE,
    trees: int = 40,
    depth: int = 10,
    prior: float = 20.0,
    host_share: float = 1.0,
    threshold: float = 0.5,
    seed: int = 42,
) -> DataFrame:
    """page, host, label, probability, host_rate, score, spam, EVIDENCE and FEATURES of every page with text.

    probability is the trees' share of votes. host_rate is the mean probability of the host's other
    pages, drawn to the overall mean by ``prior`` pages; its log-odds against that mean, times
    ``host_share``, shift the page's. Null texts and ids are left out, empty texts are honest; null and
    blank hosts share one rate; repeated pages count each; where weak labels hold one class only, the
    label is the probability (0 where there is none). About ``sample`` pages of each class, chosen by a hash of the id,
    train the trees.
    """
    f = materialize(with_views(pages, page_id, text, host).withColumn("label", weak_label()))
    counts = {r[0]: r[1] for r in f.groupBy("label").count().collect()}
    n0, n1 = counts.get(0.0, 0), counts.get(1.0, 0)
    place = F.pmod(F.xxhash64("page", F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    keep = F.when(F.col("label") == 1.0, min(1.0, sample / max(1, n1))).when(F.col("label") == 0.0, min(1.0, sample / max(1, n0)))
    if n0 and n1:
        chosen = f.filter(place < keep).select("label", *FEATURES)
        gather = VectorAssembler(inputCols=list(FEATURES), outputCol="__x")
        forest = RandomForestClassifier(labelCol="label", featuresCol="__x", numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", bootstrap=True, maxBins=64, minInstancesPerNode=2, seed=seed, probabilityCol="__p", rawPredictionCol="__r", predictionCol="__c")
        model = forest.fit(gather.transform(materialize(chosen)).select("__x", "label"))
        scored = model.transform(gather.transform(f)).withColumn("probability", vector_to_array("__p")[1]).drop("__x", "__p", "__r", "__c")
    else:
        scored = f.withColumn("probability", F.coalesce("label", F.lit(0.0)))
    scored = materialize(scored)
    mean = scored.agg(F.coalesce(F.avg("probability"), F.lit(0.0))).first()[0]
    hosts = materialize(scored.groupBy("host").agg(F.sum("probability").alias("__sum"), F.count("*").alias("__n")))
    out = lookup_join(scored, hosts, ["host"])
    out = out.withColumn("host_rate", (F.col("__sum") - F.col("probability") + prior * mean) / (F.col("__n") - 1 + prior)).drop("__sum", "__n")
    centre = math.log(max(mean, 1e-4) / max(1 - mean, 1e-4))
    shift = _log_odds(F.col("host_rate")) - F.lit(centre)
    out = out.withColumn("score", 1 / (1 + F.exp(-(_log_odds(F.col("probability")) + host_share * shift))))
    return out.select("page", "host", "label", "probability", "host_rate", "score", (F.col("score") >= threshold).alias("spam"), *EVIDENCE, *FEATURES)
