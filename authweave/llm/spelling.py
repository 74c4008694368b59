"""Spelling variants: words one edit apart, the rare one pointing at the frequent one.

Of two words that differ by one inserted, deleted or replaced character, the shorter one (of
equal length: either) is cut into two disjoint chunks, its halves; the edit leaves one of them
whole. The other word gives its positional grams of the chunks' lengths. Of these only those
within shift one of a chunk's place can meet one: where it stood, or one further on. Chunk and
gram meet by text, lengths and place, and what is left of both words is compared there.
Everything is DataFrame functions; the only large input, the texts, is read once.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authweave.llm.tables import again, forget, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "A-Za-z\\u00C0-\\u00FF"


def words(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 7, twice: int = 2,
    every: int = 31,
) -> DataFrame:
    """(word, n): words of at least `least` characters with their n >= `twice` occurrences.

    Runs of letters are lower-cased (A-Z only). Where the checksum of `id:run` is divisible by
    `every`, one character of the run is left out: such slips are the misspellings of a text
    without any. Runs too short to become a word are not sent anywhere, and counts are made per
    task before they are sent.
    """
    found = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))).alias("run"),
    )
    run = F.translate("run", UPPER, LOWER)
    lowered = found.select(run.alias("run"), F.crc32(F.concat("id", F.lit(":"), run).cast("binary")).alias("h"))
    at = F.pmod("h", F.char_length("run").cast("long")).cast("int")
    slipped = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    word = F.when(F.pmod("h", F.lit(every).cast("long")) == 0, slipped).otherwise(F.col("run"))
    return (
        lowered.select(word.alias("word")).where(F.char_length("word") >= least)
        .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= twice)
    )


def _part(start: Column | int, size: Column | int) -> Column:
    """Characters of the word from `start`, counted from 0."""
    first, length = (x if isinstance(x, Column) else F.lit(x) for x in (start, size))
    return F.substring(F.col("word"), first + 1, length)


def _sides(vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(which, size, longer, part, rest, word, n) of chunks and of grams.

    `size` is the length of the word that gives chunks, `longer` how much longer the other
    word is, `which` the chunk. The rest is the word without the part.
    """
    length = F.char_length("word")
    half = F.expr("char_length(word) div 2")
    chunks = [
        F.struct(
            F.lit(which).alias("which"), length.alias("size"), F.lit(longer).alias("longer"),
            part.alias("part"), rest.alias("rest"),
        )
        for longer in (0, 1)
        for which, part, rest in (
            (1, _part(0, half), _part(half, length)), (2, _part(half, length), _part(0, half))
        )
    ]
    grams = []
    for longer in (0, 1):
        size = length - longer  # of the other word; its second chunk stands `longer` further on here
        cut = F.expr(f"(char_length(word) - {longer}) div 2")
        for which, part, rest in (
            (1, _part(0, cut), _part(cut, length)),
            (2, _part(cut + longer, length), _part(0, cut + longer)),
        ):
            grams.append(F.struct(
                F.lit(which).alias("which"), size.alias("size"), F.lit(longer).alias("longer"),
                part.alias("part"), rest.alias("rest"),
            ))
    return tuple(side.select("word", "n", F.inline(F.array(*rows))) for side, rows in (
        (vocabulary, chunks), (again(vocabulary), grams)
    ))


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): every pair of words one edit apart, once. The vocabulary is stored; its
    words have two characters at least.

    A pair that both chunks find counts where the first chunk found it. Keys that many
    words share are ordinary skewed keys of a join of two shuffles.
    """
    chunks, grams = _sides(vocabulary)
    a, b = chunks.alias("a"), grams.alias("b")
    first = F.substring(F.col("b.rest"), F.lit(1), F.expr("a.size div 2"))
    return a.join(
        b,
        (F.col("a.part") == F.col("b.part")) & (F.col("a.size") == F.col("b.size"))
        & (F.col("a.longer") == F.col("b.longer")) & (F.col("a.which") == F.col("b.which"))
        & ((F.col("a.longer") == 1) | (F.col("a.word") < F.col("b.word")))
        & ((F.col("a.which") == 1) | (first != F.col("a.rest")))
        & (F.levenshtein(F.col("a.rest"), F.col("b.rest"), 1) == 1),
    ).select(
        F.col("a.word").alias("a"), F.col("a.n").alias("a_n"), F.col("b.word").alias("b"), F.col("b.n").alias("b_n")
    )


def forms(vocabulary: DataFrame, times: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n): near words counted, the most frequent as form.

    Of equally frequent near words the first in code-point order is taken; it is a form if it
    occurs at least `times` as often as the word.
    """
    pairs = near_pairs(vocabulary)
    to = lambda word, n, other, its: F.struct(
        F.col(word).alias("word"), F.col(n).alias("n"),
        F.struct((-F.col(its)).alias("order"), F.col(other).alias("near")).alias("best"),
    )
    both = pairs.select(F.inline(F.array(to("a", "a_n", "b", "b_n"), to("b", "b_n", "a", "a_n"))))
    lone = again(vocabulary).select(
        "word", "n", F.lit(None).cast(both.schema["best"].dataType).alias("best")
    )
    counted = both.unionByName(lone).groupBy("word", "n").agg(
        F.count("best").alias("n_near"), F.min("best").alias("best")
    )
    enough = -F.col("best.order") >= times * F.col("n")
    return counted.select(
        "word", "n", "n_near", F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.order")).alias("form_n"),
    )


def roots(found: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: the end of the chain of forms.

    Each round doubles the steps taken. A form occurs `times` as often as its word, so chains
    are no longer than the logarithm of the largest count.
    """
    now = stored(found.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = again(now).select(F.col("word").alias("root"), F.col("root").alias("next"))
        later = stored(
            now.join(ahead, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ), "roots",
        )
        forget(now)
        now = stored(later.select("word", "root"), "roots")
        moved = later.where("moved").limit(1).count()
        forget(later)
        if not moved:
            return now


def group_variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 7, twice: int = 2,
    every: int = 31, times: int = 10,
) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    Null and empty texts and empty tables have no words; a null id counts as an empty one.
    Repeated rows are counted as often as they stand there. Texts of any length are read whole,
    one row at a time. Equally frequent near words are taken in code-point order. Other columns
    of `docs`, whatever their names, take no part.
    """
    vocabulary = stored(words(docs, doc_id, text, least, twice, every), "words")
    found = stored(forms(vocabulary, times), "forms")
    ends = roots(found)
    return found.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
