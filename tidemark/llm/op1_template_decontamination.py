"""Benchmark decontamination by templates.

Numbers, units and names become typed placeholders; windows of the resulting templates
are joined between documents and benchmark items, and a matched passage counts only if
its slots are filled consistently: along one alignment, every benchmark value is always
replaced by the same document value. That finds verbatim copies and re-parameterised
questions alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import RID, WindowHash, mix64, restore_ids, store, table, text_chunks, with_row_ids

WINDOW = 8
#: words in a window that must be neither number, unit nor name
LITERALS = 4
#: an item counts as contaminated from this many covered tokens, or this share of its tokens, on
MIN_TOKENS, MIN_PERCENT = 13, 50
#: bits of the prefilter that tasks hold; a false positive only costs a row in the join
FILTER_BITS = 1 << 22
#: distinct words a task keeps
KEPT_WORDS = 1 << 17

#: fixed values: number words
NUMBER_WORDS = frozenset("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen
fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand
million billion half third quarter dozen""".split())
#: fixed values: units of measure, time and money
UNITS = frozenset("""mm cm m km inch inches foot feet yard yards mile miles g kg mg gram grams kilogram kilograms ton
tons pound pounds lb lbs ounce ounces oz ml l liter liters litre litres gallon gallons second seconds minute minutes
hour hours day days week weeks month months year years cent cents dollar dollars euro euros usd eur percent % degree
degrees mph kph watt watts volt volts meter meters metre metres kilometer kilometers kilometre kilometres""".split())

LITERAL, NUMBER, UNIT, NAME = 0, 1, 2, 3
#: forms of a window: template with names, template with names as plain words, exact tokens
NAMED, FOLDED, EXACT = 0, 1, 2
_PLACE = np.array([0, 0x5151515151515151, 0x6262626262626262, 0x7373737373737373], dtype=np.uint64)
_NUMERIC = frozenset("0123456789.,/:%$€£+-")
_EDGE = "\"'`.,;:!?()[]{}<>«»“”‘’„…*_|"


class _Words(dict):
    """Word -> number; its class, hash, plain form and whether a sentence ends after it."""

    def __init__(self):
        super().__init__()
        self.kind, self.hash, self.plain, self.ends = [], [], [], []

    def __missing__(self, raw: bytes) -> int:
        word = raw.decode("utf-8", "replace")
        core = word.strip(_EDGE)
        low = core.casefold()
        if any(c.isdigit() for c in core) and all(c in _NUMERIC or c.isdigit() for c in core) or low in NUMBER_WORDS:
            kind = NUMBER
        elif low in UNITS:
            kind = UNIT
        elif core[:1].isupper():
            kind = NAME  # unless it begins a sentence
        else:
            kind = LITERAL
        n = self[raw] = len(self)
        self.kind.append(kind)
        self.hash.append(xxhash.xxh64_intdigest(low.encode()) if low else 0)
        self.plain.append(low)
        self.ends.append(word.rstrip("\"'`)]}»”’")[-1:] in (".", "!", "?"))
        return n


class Canonical:
    """The template tokens of some texts: hash and class of every token, and the text it belongs to."""

    def __init__(self, texts: list[bytes], words: _Words):
        split = [t.split() for t in texts]
        n = np.array([len(w) for w in split], dtype=np.int64)
        get = words.__getitem__
        no = np.fromiter((x for w in split for x in map(get, w)), dtype=np.int64, count=int(n.sum()))
        doc = np.repeat(np.arange(len(texts)), n)
        kind, code = np.array(words.kind, dtype=np.int8)[no], np.array(words.hash, dtype=np.uint64)[no]
        begins = np.ones(len(no), dtype=bool)
        begins[1:] = np.array(words.ends, dtype=bool)[no[:-1]] | (doc[1:] != doc[:-1])
        real = code != 0  # bare punctuation is no token
        self.no, self.doc, kind, code = no[real], doc[real], kind[real], code[real]
        named = np.where((kind == NAME) & begins[real], LITERAL, kind)
        # the classes without names depend on neither case nor sentence
        self.kinds = {NAMED: named, FOLDED: np.where(kind == NAME, LITERAL, kind)}
        self.kinds[EXACT] = self.kinds[FOLDED]
        self.codes = {f: mix64(np.where(self.kinds[f] == LITERAL, code, _PLACE[self.kinds[f]])) for f in (NAMED, FOLDED)}
        self.codes[EXACT] = mix64(code)
        self.size = np.bincount(self.doc, minlength=len(texts))
        self.first = np.cumsum(self.size) - self.size

        self._hash = {f: WindowHash(c) for f, c in self.codes.items()}

    def windows(self, length: int, literals: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(form, starts, hashes) of all windows.

        A window has a template with names and, where it holds names, one without, if enough
        tokens are literal; if even without names too few are, it has its exact tokens.
        """
        n = len(self.no) - length + 1
        if n <= 0:
            return
        start = np.flatnonzero(self.doc[:n] == self.doc[length - 1:])
        count = {}
        for f in (NAMED, FOLDED):
            lit = np.append(0, np.cumsum(self.kinds[f] == LITERAL))
            count[f] = lit[start + length] - lit[start]
        chosen = {NAMED: count[NAMED] >= literals, FOLDED: (count[FOLDED] >= literals) & (count[FOLDED] > count[NAMED]),
                  EXACT: count[FOLDED] < literals}
        for f, some in chosen.items():
            own = start[some]
            if len(own):
                yield f, own, self._hash[f](own, own + length)

    def template(self, form: int, at: int, length: int, words: _Words) -> tuple[str, list[dict]]:
        """The window's template, or exact tokens, as text, and its slots in order."""
        out, slots = ["="] if form == EXACT else [], []
        for i in range(at, at + length):
            k = int(self.kinds[form][i])
            plain = words.plain[self.no[i]]
            out.append(("", "<number>", "<unit>", "<name>")[k] if k and form != EXACT else plain)
            if k:
                slots.append({"kind": k, "value": plain})
        return " ".join(out), slots


_SLOT = pa.list_(pa.struct([("kind", pa.int32()), ("value", pa.string())]))
_WIN = pa.schema([("h", pa.int64()), ("id", pa.int64()), ("pos", pa.int64()), ("len", pa.int32()),
                  ("n_tokens", pa.int64()), ("template", pa.string()), ("slots", _SLOT)])
_WIN_DDL = "h long, id long, pos long, len int, n_tokens long, template string, slots array<struct<kind:int,value:string>>"


def _windows_task(lengths: list[int] | None, bits: bytes | None):
    """Windows of the given lengths that may be in the filter; for items (no lengths) their own windows."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        table_ = None if bits is None else np.frombuffer(bits, dtype=bool)
        for ids, texts in text_chunks(batches, 1 << 20):
            if len(words) > KEPT_WORDS:
                words = _Words()
            c = Canonical(texts, words)
            rows = []
            for length in lengths or range(1, WINDOW + 1):
                # a short window must be literal but for one token
                for form, start, h in c.windows(length, min(LITERALS, max(1, length - 1))):
                    if lengths is None:  # an item shorter than the window is one window
                        own = (c.size[c.doc[start]] == length) | (length == WINDOW)
                        start, h = start[own], h[own]
                    if table_ is not None:
                        hit = table_[(h & np.uint64(FILTER_BITS - 1)).astype(np.int64)]
                        start, h = start[hit], h[hit]
                    for s, x in zip(start.tolist(), h.view(np.int64).tolist(), strict=True):
                        d = int(c.doc[s])
                        template, slots = c.template(form, s, length, words)
                        rows.append({"h": x, "id": ids[d], "pos": s - int(c.first[d]), "len": length,
                                     "n_tokens": int(c.size[d]), "template": template, "slots": slots})
            yield pa.RecordBatch.from_pylist(rows, schema=_WIN)
    return task


def _prefilter(windows: DataFrame) -> bytes:
    """One byte a slot: which low bits of window hashes occur; at most FILTER_BITS values reach the driver."""
    seen = np.zeros(FILTER_BITS, dtype=bool)
    rows = windows.select(F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1)).cast("int").alias("b")).distinct().toArrow()
    seen[rows.column("b").to_numpy()] = True
    return seen.tobytes()


def contaminated(docs: DataFrame, benchmark: DataFrame, min_tokens: int = MIN_TOKENS,
                 min_percent: int = MIN_PERCENT) -> DataFrame:
    """The pairs of a row of ``docs`` (doc_id, text) and a row of ``benchmark`` (item_id, text) that share a passage.

    Tokens are white-space separated words, case-folded, without outer punctuation;
    numbers (digits or number words), units and names (capitalised words that do not
    begin a sentence) become placeholders. Windows of eight tokens with at least four
    literal ones are matched by template, with names as placeholders or as plain words;
    windows with fewer literal ones by their exact tokens. An item of fewer than eight
    tokens is one window and must match whole.
    Matches at one offset form an alignment; where it gives one benchmark value two
    document values, the windows that hold that value are dropped, unless all their values
    are the benchmark's own. A pair is reported when the tokens of the item that the
    remaining windows cover number at least ``min_tokens`` or ``min_percent`` of it.

    Returns doc_id, item_id, covered_tokens, item_tokens, reparameterised (some slot
    value differs). Null and empty texts match nothing; empty tables give an empty result; repeated rows are reported
    each. Rows with null or repeated ids are rows of their own. Other columns are ignored.
    """
    d, d_own = with_row_ids(docs)
    b, b_own = with_row_ids(benchmark, "item_id")
    items = store(b.select(RID, "text").mapInArrow(_windows_task(None, None), _WIN_DDL), "benchmark_windows")
    lengths = sorted(r["len"] for r in items.select("len").distinct().collect())  # at most WINDOW values
    hits = d.select(RID, "text").mapInArrow(_windows_task(lengths or [WINDOW], _prefilter(items)), _WIN_DDL)
    i = items.select("h", "len", "template", F.col("id").alias("item"), F.col("pos").alias("item_pos"),
                     F.col("n_tokens").alias("item_tokens"), F.col("slots").alias("item_slots"))
    found = store(hits.join(i, ["h", "len", "template"])
                  .select(F.col("id").alias("doc"), "item", (F.col("pos") - F.col("item_pos")).alias("shift"), "item_pos",
                          "len", "item_tokens", F.arrays_zip(F.col("item_slots").alias("x"), F.col("slots").alias("y"))
                          .alias("slots")), "matched_windows")
    key = ["doc", "item", "shift"]
    value = found.select(*key, F.explode("slots").alias("s")).select(
        *key, F.col("s.x.kind").alias("kind"), F.col("s.x.value").alias("old"), F.col("s.y.value").alias("new"))
    # the benchmark values that an alignment gives two document values; at most as many as the item has
    mixed = (value.groupBy(*key, "kind", "old").agg(F.min("new").alias("lo"), F.max("new").alias("hi")).filter("lo != hi")
             .groupBy(*key).agg(F.collect_set(F.struct("kind", F.col("old").alias("value"))).alias("mixed")))
    changed = F.exists("slots", lambda s: s["x"]["value"] != s["y"]["value"])
    held = F.arrays_overlap(F.transform("slots", lambda s: F.struct(s["x"]["kind"].alias("kind"), s["x"]["value"].alias("value"))),
                            F.col("mixed"))
    good = (found.join(mixed, key, "left").withColumn("changed", changed)
            .filter(F.col("mixed").isNull() | ~F.col("changed") | ~held))
    covered = (good.select("doc", "item", "item_tokens", "changed",
                           F.explode(F.sequence("item_pos", F.col("item_pos") + F.col("len") - 1)).alias("token"))
               .groupBy("doc", "item", "token").agg(F.max("item_tokens").alias("item_tokens"),
                                                    F.max("changed").alias("changed"))
               .groupBy("doc", "item").agg(F.count(F.lit(1)).alias("covered_tokens"),
                                           F.max("item_tokens").alias("item_tokens"),
                                           F.max("changed").alias("reparameterised")))
    out = covered.filter((F.col("covered_tokens") >= min_tokens)
                         | (100 * F.col("covered_tokens") >= min_percent * F.col("item_tokens")))
    out = restore_ids(out.withColumnRenamed("item", RID), b, b_own, "item_id").withColumnRenamed("doc", RID)
    out = restore_ids(out, d, d_own)
    return out.select("doc_id", "item_id", "covered_tokens", "item_tokens", "reparameterised")


def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items: one row per contaminated document and item."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
