"""Spelling variants by a variable-length gram index.

Every position of a padded word gives one gram: three characters, made longer (to five at
most) while the gram so far is frequent in the vocabulary, so the frequent ones are pruned
from the dictionary. One edit changes only the grams that cover it; the most that any edit
of a word can change is its bound. Of each word's grams, taken in one global order with
the rarest first, one more than the bound are listed, so two near words always share a
listed gram that the edit left alone. That gram stands left or right of the edit, so lists
are kept by the gram with all that precedes it and by the gram with all that follows. The
words of a list are compared with each other inside tasks, large lists in pairs of blocks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import ranges
from tidemark.llm.common import store, table

#: shortest and longest gram; words need SHORT + 1 characters for the bound to leave a gram
SHORT, LONG = 3, 5
#: a gram is frequent when it takes more than this share of all positions, so at most
#: (LONG - SHORT + 1) times as many grams are frequent, however large the vocabulary is
SHARE = 50_000
#: members of one list on either side of a comparison; larger lists are dealt in blocks
BLOCK = 1000
#: distinct grams a task counts before it sends them on; rows and pairs compared at a time
HELD, ROWS, PAIRS = 200_000, 50_000, 400_000
#: characters up to which words are compared as rows of a matrix
WIDTH = 32
FRONT, BACK = "\x01", "\x02"


def word_counts(docs: DataFrame, min_chars: int = 6, min_n: int = 5, modulus: int = 199) -> DataFrame:
    """(word, n) of the letter runs of ``docs`` (doc_id, text), A-Z in lower case, a few with one letter deleted.

    A run loses the character at crc32 % length when ``modulus`` divides the crc32 of
    ``doc_id:run`` (0: none does). Words of fewer than ``min_chars`` characters or
    ``min_n`` occurrences are left out. A null text has no runs, a null doc_id counts as
    an empty text.
    """
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    run = (docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), low.alias("low"))
           .select("id", F.explode(F.regexp_extract_all("low", F.lit("[a-zÀ-ÿ]+"), F.lit(0))).alias("w"))
           .filter(F.length("w") >= min_chars))
    if modulus:
        h = F.crc32(F.concat("id", F.lit(":"), "w").cast("binary"))
        at = (F.col("h") % F.length("w")).cast("int")
        cut = F.concat(F.col("w").substr(F.lit(1), at), F.col("w").substr(at + 2, F.length("w")))
        run = run.withColumn("h", h).select(F.when(F.col("h") % modulus == 0, cut).otherwise(F.col("w")).alias("w"))
        run = run.filter(F.length("w") >= min_chars)
    return run.groupBy(F.col("w").alias("word")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_n)


def _padded(word: str) -> str:
    return FRONT * (SHORT - 1) + word + BACK * (LONG - 1)


def _gram_counts():
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_pydict({"gram": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})
        for batch in batches:
            for word in batch.column(0).to_pylist():
                w = _padded(word)
                starts = range(len(word) + SHORT - 1)
                for q in range(SHORT, LONG + 1):
                    held.update([w[p:p + q] for p in starts])
                if len(held) > HELD:
                    yield rows()
                    held.clear()
        if held:
            yield rows()
    return task


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """The grams that extend, with their counts: at most (LONG - SHORT + 1) * SHARE."""
    total = words.agg(F.sum(F.length("word") + SHORT - 1).alias("n")).first()["n"] or 0
    counts = words.select("word").mapInArrow(_gram_counts(), "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: r["n"] for r in counts.filter(F.col("n") > total // SHARE).collect()}


def grams(word: str, frequent: dict[str, int]) -> list[str]:
    """The gram at each position of the padded word; it depends on its own characters only."""
    w, out = _padded(word), []
    for p in range(len(word) + SHORT - 1):
        q = SHORT
        while q < LONG and w[p:p + q] in frequent:
            q += 1
        out.append(w[p:p + q])
    return out


def affected(found: list[str]) -> int:
    """The most grams that a single edit of the word can change: those that cover one of its characters."""
    edge = [0] * (len(found) + LONG + 1)
    for p, g in enumerate(found):
        edge[p] += 1
        edge[p + len(g)] -= 1
    most = now = 0
    for p, e in enumerate(edge):
        now += e
        if SHORT - 1 <= p < len(found):
            most = max(most, now)
    return most


def list_keys(word: str, frequent: dict[str, int]) -> set[str]:
    """The lists of a word: its rarest grams, one more than an edit can change, with what precedes or follows them."""
    found = grams(word, frequent)
    # grams of full length may be frequent still; equal grams are listed together, so that ties cannot part near words
    order = [(frequent.get(g, 0) if len(g) == LONG else 0, g) for g in found]
    last = sorted(order)[affected(found)]
    w, out = _padded(word), set()
    for p, g in enumerate(found):
        if order[p] <= last:
            if p + len(g) <= SHORT - 1 + len(word):
                out.add("<" + w[:p + len(g)])
            if p >= SHORT - 1:
                out.add(">" + w[p:])
    return out


def _list_task(frequent):
    schema = pa.schema([("list", pa.int64()), ("word", pa.string()), ("n", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent.value
        for batch in batches:
            lists, word, n = [], [], []
            for w, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys = list_keys(w, known)
                lists += [xxhash.xxh64_intdigest(x.encode()) for x in keys]
                word += [w] * len(keys)
                n += [k] * len(keys)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(lists, dtype=np.uint64).view(np.int64)), pa.array(word, pa.string()),
                                              pa.array(n, pa.int64())], schema=schema)
    return task


def one_edit(a: str, b: str) -> bool:
    """Whether two different words differ by one inserted, deleted or replaced character."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def _matrix(words: list[str], size: np.ndarray, right: bool) -> np.ndarray:
    """The words as rows of characters, filled up with zeros on one side."""
    joined = "".join(words)
    try:
        flat = np.frombuffer(joined.encode("latin-1"), dtype=np.uint8)
    except UnicodeEncodeError:
        flat = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    out = np.zeros((len(words), WIDTH), dtype=flat.dtype)
    row = np.repeat(np.arange(len(words)), size)
    col = ranges(WIDTH - size if right else np.zeros_like(size), size)
    out[row, col] = flat
    return out


def near_pairs(group: np.ndarray, side: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Indices (x, y) of the words of one group that are one edit apart; side 2 meets its group, 0 meets 1."""
    size = np.array([len(w) for w in words], dtype=np.int64)
    o = np.lexsort((size, group))
    g, s, n = group[o], side[o], size[o]
    # within a group by length: partners follow, up to one character longer
    at = g * (int(n.max()) + 2) + n
    stop = np.searchsorted(at, at + 1, side="right")
    many = stop - np.arange(len(o)) - 1
    short = n <= WIDTH
    chars = [words[k] if len(words[k]) <= WIDTH else "" for k in o.tolist()]
    width = np.where(short, n, 0)
    left, right = _matrix(chars, width, False), _matrix(chars, width, True)
    cut = np.cumsum(many)
    out, low = [], 0
    while low < len(o):
        high = max(low + 1, int(np.searchsorted(cut, (cut[low - 1] if low else 0) + PAIRS, side="right")))
        x = np.repeat(np.arange(low, high), many[low:high])
        y = ranges(np.arange(low, high) + 1, many[low:high])
        met = (s[x] == 2) | (s[x] != s[y])
        x, y = x[met], y[met]
        low = high
        if not len(x):
            continue
        far = ~(short[x] & short[y])
        same_front = (left[x] != left[y]).argmax(axis=1)
        same_back = (right[x] != right[y])[:, ::-1].argmax(axis=1)
        near = (same_front + same_back >= n[y] - 1) & ~far
        for k in np.flatnonzero(far).tolist():
            near[k] = one_edit(words[o[x[k]]], words[o[y[k]]])
        out.append((o[x[near]], o[y[near]]))
    if not out:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate([p for p, _ in out]), np.concatenate([q for _, q in out])


def _pair_task():
    """Rows sorted by (list, i, j) -> each pair of near words, smaller word first."""
    schema = pa.schema([("a", pa.string()), ("an", pa.int64()), ("b", pa.string()), ("bn", pa.int64())])

    def pairs(keys, sides, words, counts):
        new = np.ones(len(words), dtype=bool)
        k = np.array(keys, dtype=np.int64)
        new[1:] = (k[1:] != k[:-1]).any(axis=1)
        x, y = near_pairs(np.cumsum(new), np.array(sides), words)
        found = {(min(words[p], words[q]), max(words[p], words[q])): (p, q) for p, q in zip(x.tolist(), y.tolist(), strict=True)}
        rows = [(a, counts[p if words[p] == a else q], b, counts[q if words[p] == a else p]) for (a, b), (p, q) in found.items()]
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sides, words, counts = [], [], [], []
        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("list", "i", "j", "side", "word", "n")]
            keys += zip(*cols[:3], strict=True)
            sides += cols[3]
            words += cols[4]
            counts += cols[5]
            if len(words) >= ROWS:
                cut = len(words)
                while cut and keys[cut - 1] == keys[-1]:
                    cut -= 1
                if cut:
                    yield pairs(keys[:cut], sides[:cut], words[:cut], counts[:cut])
                    del keys[:cut], sides[:cut], words[:cut], counts[:cut]
        if words:
            yield pairs(keys, sides, words, counts)
    return task


def near_words(words: DataFrame) -> DataFrame:
    """(a, an, b, bn): every pair of ``words`` (word, n) that is one edit apart, once, a < b."""
    spark = words.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frequent = spark.sparkContext.broadcast(frequent_grams(words))
    lists = store(words.select("word", "n").mapInArrow(_list_task(frequent), "list long, word string, n long"), "gram_lists")
    size = (lists.groupBy("list").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
            .select("list", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    rows = (lists.join(size, "list").withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("list", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                    F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
                    "word", "n"))
    return (rows.repartition(parts, "list", "i", "j").sortWithinPartitions("list", "i", "j")
            .mapInArrow(_pair_task(), "a string, an long, b string, bn long").distinct())


def spelling_forms(words: DataFrame, ratio: int = 5) -> DataFrame:
    """``words`` (word, n; distinct, of four characters or more) with their near words and forms.

    A word's form is its near word of largest n (ties: smallest in code-point order), if
    that n is at least ``ratio`` times the word's own; its root is found by following forms
    to the last. Returns word, form, root, n, n_near, form_n. Words without near words have
    n_near 0, and without a form are their own root. A null word is left out; an empty table
    gives an empty result. Words must not hold U+0001 and U+0002, which pad them.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, or forms could run in a circle")
    words = store(words.select("word", "n").filter(F.col("word").isNotNull()), "words")
    if words.filter(F.length("word") <= SHORT).limit(1).count():
        raise ValueError(f"words need more than {SHORT} characters")
    pairs = store(near_words(words), "near_words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("bn").alias("an"), F.col("a").alias("b"), F.col("an").alias("bn")))
    best = (both.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"),
                                                       F.min(F.struct((-F.col("bn")).alias("m"), F.col("b").alias("b"))).alias("best")))
    form = F.col("n_near").isNotNull() & (-F.col("best.m") >= ratio * F.col("n"))
    found = store(words.join(best, "word", "left")
                  .select("word", F.when(form, F.col("best.b")).alias("form"), "n",
                          F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                          F.when(form, -F.col("best.m")).alias("form_n")), "forms")
    # forms only lead to larger n, so doubling the steps ends after the logarithm of the longest chain
    step = store(found.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = store(step.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                              F.col("next").isNotNull().alias("moved")), "roots")
        if not step.filter("moved").limit(1).count():
            break
        step = step.drop("moved")
    return (found.join(step.select("word", "root"), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the words of all documents that occur five times or more."""
    return spelling_forms(word_counts(table(spark, sf_dir, "documents")))
