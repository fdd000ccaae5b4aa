"""Substring dedup by repeated-phrase automata.

1. Seeds. Documents form blocks. In a block, every window of `window` words picks one of its `phrase`-word phrases by the
   least hash, so equal windows pick equal phrases wherever they stand; each picked phrase is noted with one place in the block.
2. Confirm. A phrase that was picked in two places recurs; its place goes back to each block that noted it.
3. Compile. A block reads the words at the confirmed places and compiles them into Aho-Corasick automata, sharded so that each
   stays small.
4. Locate. All documents of the block stream through its automata, which give every occurrence of every phrase. These hits are
   all that the later steps see: windows without a hit are left alone, the others are named by the least phrase that was hit in
   them and by a hash of their words (128 bits together).
5. Decide. Of the windows of one name the earliest stays; the words of all later ones go.

A document meets only the automata of its own block: the work grows with the corpus, not with
documents times phrases. The words are tokens `[^\\x20\\x09-\\x0D]+`, unchanged.

Null, empty or short texts lose nothing. Rows that repeat a doc_id count as later documents in the
order of their texts; rows without an id come after all others, blockwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, compress

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orogen.llm.common import hash_words, rolling, slices, table, word_ids

WINDOW = 20
PHRASE = 6
#: Phrases in one automaton: some 25 symbols of under 100 bytes each.
SHARD = 40_000
#: Text in one block of documents, on average.
BLOCK_BYTES = 8 << 20
#: Windows in one stretch, at most: later ones are marked by the bits of a long.
STRETCH = 60
#: Odd multipliers of the rolling hashes of phrases and of windows.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

_TOP = np.uint64(2**64 - 1)
_LOW = 2**32 - 1


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over each run of `width` values, by doubling."""
    if len(values) < width:
        return values[:0]
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


class Block:
    """The words of some texts side by side, as one array of ids."""

    def __init__(self, texts: pa.Array, window: int, phrase: int):
        self.window, self.phrase = window, phrase
        self.ids, self.words, self.counts = word_ids(texts)
        self.starts = np.cumsum(self.counts) - self.counts
        self.hashes = hash_words(self.words)[self.ids] if len(self.ids) else np.zeros(0, np.uint64)
        n = max(len(self.ids) - window + 1, 0)
        ends = np.repeat(self.starts + self.counts, self.counts)[:n]
        self.whole = np.arange(n) + window <= ends  # windows that stay inside one text

    def seeds(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, first place, whether there are more places) of the phrases that windows pick."""
        none = np.zeros(0, np.int64)
        if not self.whole.any():
            return none.view(np.uint64), none, none.astype(bool)
        grams = rolling(self.hashes, self.phrase, BASES[0])
        reach = self.window - self.phrase
        pad = np.zeros(reach, dtype=np.uint64)
        least = np.concatenate([pad, np.where(self.whole, _sliding(grams, reach + 1, np.minimum), 0), pad])
        picked = np.flatnonzero(_sliding(least, reach + 1, np.maximum) == grams)
        hashes, first, times = np.unique(grams[picked], return_index=True, return_counts=True)
        return hashes, picked[first], times > 1

    def hits(self, places: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """For each place the hash of the phrase that the automata find there (the greatest number: none). The phrases are read at `places`."""
        found = np.full(max(len(self.ids) - self.phrase + 1, 0), _TOP)
        order = np.argsort(places, kind="stable")  # neighbours share words, so shards keep few of them
        for at in range(0, len(order), SHARD):
            own = order[at : at + SHARD]
            end, which = self._stream(places[own])
            found[end - self.phrase + 1] = hashes[own][which]
        return found

    def _stream(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Compile the phrases at these places; (last word, number of the phrase) of each occurrence in all texts.

        A word of a phrase is spelt with three symbols (base 94), all other words with one symbol that
        no phrase has: a node then has few children and a phrase 18 symbols, whatever the words' lengths.
        """
        spelt = self.ids[places[:, None] + np.arange(self.phrase)]
        code = np.zeros(len(self.words), dtype=np.int64)
        used = np.unique(spelt)
        code[used] = np.arange(1, len(used) + 1)
        symbols = np.stack([code // 94**2, code // 94 % 94, code % 94], 1).astype(np.uint8) + 33
        symbols[code == 0] = 32
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for number, key in enumerate(symbols[spelt].reshape(len(places), -1)):
            automaton.add_word(key.tobytes().decode("latin-1"), number)
        automaton.make_automaton()
        ends, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start, count in zip(self.starts.tolist(), self.counts.tolist(), strict=True):
            if count >= self.window:
                stream = symbols[self.ids[start : start + count]].tobytes().decode("latin-1")
                got = np.fromiter(chain.from_iterable(automaton.iter(stream)), dtype=np.int64).reshape(-1, 2)
                got = got[got[:, 0] % 3 == 2]  # on a word's last symbol
                ends.append(start + got[:, 0] // 3)
                numbers.append(got[:, 1])
        return np.concatenate(ends), np.concatenate(numbers)


def _by_id(docs: pa.Table) -> pa.Table:
    return docs.sort_by([("id", "ascending"), ("text", "ascending")]).combine_chunks()


def _texts(docs: pa.Table) -> pa.Array:
    return pc.fill_null(docs["text"].combine_chunks(), "")


def _places(docs: pa.Table) -> np.ndarray:
    """Per row of a sorted block: its number among the rows of its id, nearly always 0, which shuffles for free; without an id, block and row."""
    row = np.arange(docs.num_rows)
    known = docs.num_rows - docs["id"].null_count  # nulls are last
    ids = docs["id"].slice(0, known).combine_chunks().to_numpy(zero_copy_only=False)
    new = np.concatenate([[True], ids[1:] != ids[:-1]])[:known]
    first = np.maximum.accumulate(np.where(new, row[:known], 0)) if known else row[:0]
    return np.concatenate([row[:known] - first, (docs["block"][0].as_py() << 32) | row[known:]])


def _rows_of(docs: pa.Table, later: pa.Table) -> np.ndarray:
    """The rows of a sorted block that ids and places name."""
    place = later["place"].to_numpy()
    known = pc.is_valid(later["id"]).to_numpy()
    ids = docs["id"].slice(0, docs.num_rows - docs["id"].null_count).combine_chunks().to_numpy(zero_copy_only=False)
    rows = place & _LOW
    rows[known] += np.searchsorted(ids, later["id"].filter(pa.array(known)).combine_chunks().to_numpy(zero_copy_only=False))
    return rows


def _seeded(docs: pa.Table, window: int, phrase: int) -> pa.Table:
    """(h, block and place, more): the phrases that the windows of a sorted block pick."""
    hashes, place, more = Block(_texts(docs), window, phrase).seeds()
    block = np.full(len(place), docs["block"][0].as_py() if len(place) else 0, dtype=np.int64)
    return pa.table({"h": hashes.view(np.int64), "at": (block << 32) | place, "more": more})


def _located(docs: pa.Table, confirmed: pa.Table, window: int, phrase: int) -> pa.Table:
    """Stretches of windows with the same least hit: (h, the windows' hashes), or without them but with `run` if all of them
    stand earlier in the same block too."""
    own = Block(_texts(docs), window, phrase)
    hits = own.hits(confirmed["at"].to_numpy() & _LOW, confirmed["h"].to_numpy().view(np.uint64))
    named = _sliding(hits, window - phrase + 1, np.minimum)
    places = np.flatnonzero(own.whole & (named < _TOP))
    h = named[places]
    key = rolling(own.hashes, window, BASES[1])[places] if len(places) else h
    order = np.lexsort((places, key, h))
    later = np.zeros(len(order), dtype=bool)
    later[order[1:]] = (np.diff(h[order]) == 0) & (np.diff(key[order]) == 0)
    row = np.searchsorted(own.starts + own.counts, places, side="right")
    parts = np.flatnonzero(np.concatenate([[True], (np.diff(places) != 1) | (np.diff(row) != 0) | (np.diff(h) != 0)])) if len(places) else places
    offset = np.arange(len(places)) - np.repeat(parts, np.diff(np.append(parts, len(places))))
    parts = np.flatnonzero(offset % STRETCH == 0)
    size = np.diff(np.append(parts, len(places)))
    known = np.logical_and.reduceat(later, parts) if len(parts) else later  # nothing that the block has not had before
    rows, at = row[parts], places[parts] - own.starts[row[parts]]
    sent = np.repeat(~known, size)
    lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(np.where(known, 0, size))]).astype(np.int32), key[sent].view(np.int64))
    spread = np.random.default_rng(0).integers(2**62, size=len(parts))  # these need no partner, only a partition
    return pa.table(
        {
            "h": np.where(known, spread, h[parts].view(np.int64)),
            "id": docs["id"].combine_chunks().take(pa.array(rows)),
            "place": _places(docs)[rows],
            "at": at.astype(np.int32),
            "keys": lists,
            "run": np.where(known, size, 0).astype(np.int32),
        }
    )


def _cleaned(docs: pa.Table, later: pa.Table, window: int) -> pa.Table:
    """The digest row of each document of a block, given its later windows: bits from a place on, or runs."""
    rows, at, run = _rows_of(docs, later), later["at"].to_numpy().astype(np.int64), later["run"].to_numpy().astype(np.int64)
    bits = np.unpackbits(later["late"].to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    stretch, k = np.nonzero(bits)
    whole = run > 0
    rows = np.concatenate([rows[stretch], rows[whole]])
    at = np.concatenate([at[stretch] + k, at[whole]])
    n = np.concatenate([np.ones(len(k), np.int64), run[whole]])
    order = np.argsort(rows, kind="stable")
    rows, at, n = rows[order], at[order], n[order]
    total, removed, kept = [], [], []
    for k, text in enumerate(_texts(docs).cast(pa.binary()).to_pylist()):
        words = text.split()
        total.append(len(words))
        a, b = np.searchsorted(rows, [k, k + 1])
        if b > a:
            edge = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(edge, at[a:b], 1)
            np.add.at(edge, at[a:b] + n[a:b] + window - 1, -1)
            words = list(compress(words, (np.cumsum(edge[:-1]) == 0).tolist()))
        removed.append(total[-1] - len(words))
        kept.append(b" ".join(words))
    return pa.table(
        {
            "id": docs["id"].combine_chunks(),
            "n_words": pa.array(total, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept": pa.array(kept, pa.binary()).cast(pa.string()),
        }
    )


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, phrase: int = PHRASE
) -> DataFrame:
    """(id_col, n_words, n_removed, kept_text: the kept words joined by one space)."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    dealt = F.pmod(F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("id")), F.lit(blocks))
    spread = texts.withColumn("block", dealt).repartition("block")  # one exchange: the plan reads it three times
    kind = texts.schema["id"].dataType.simpleString()

    def seeded(docs: pa.Table) -> pa.Table:
        return _seeded(_by_id(docs), window, phrase)

    def located(docs: pa.Table, confirmed: pa.Table) -> pa.Table:
        return _located(_by_id(docs), confirmed, window, phrase)

    def cleaned(docs: pa.Table, late: pa.Table) -> pa.Table:
        return _cleaned(_by_id(docs), late, window)

    seeds = spread.groupBy("block").applyInArrow(seeded, "h long, at long, more boolean").repartition("h")
    noted = F.count("*").over(Window.partitionBy("h"))  # no phrase has more rows than blocks
    confirmed = seeds.withColumn("n", noted).where("more or n > 1").select("h", "at", F.shiftright("at", 32).alias("block"))
    stretches = spread.groupBy("block").cogroup(confirmed.groupBy("block")).applyInArrow(
        located, f"h long, id {kind}, place long, at int, keys array<long>, run int"
    )
    stretches = stretches.repartition("h")
    each = stretches.select("h", "id", "place", "at", "run", F.posexplode_outer("keys").alias("k", "key"))
    order = [F.col("id").isNull(), "id", "place", F.col("at") + F.col("k")]
    rank = F.row_number().over(Window.partitionBy("h", "key").orderBy(*order))
    late = F.coalesce(F.bit_or(F.when(F.col("rank") > 1, F.expr("shiftleft(1L, k)"))), F.lit(0).cast("long"))
    block = F.when(F.col("id").isNull(), F.shiftright("place", 32)).otherwise(F.pmod(F.xxhash64("id"), F.lit(blocks)))
    later = (
        each.withColumn("rank", rank)
        .groupBy("h", "id", "place", "at", "run")
        .agg(late.alias("late"))
        .where("late <> 0 or run > 0")
        .select(block.alias("block"), "id", "place", "at", "late", "run")
    )
    out = spread.groupBy("block").cogroup(later.groupBy("block")).applyInArrow(
        cleaned, f"id {kind}, n_words long, n_removed long, kept string"
    )
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", F.col("kept").alias("kept_text"))


def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = F.sha2("kept_text", 256).alias("kept_sha256")
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", kept)


ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, pos, array_to_string(w[pos + 1:pos + 20], ' ') AS phrase
  FROM (SELECT doc_id, w, unnest(range(len(w) - 19)) AS pos FROM words WHERE len(w) >= 20)
), late AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY phrase ORDER BY doc_id, pos) AS nth FROM windows) WHERE nth > 1
), gone AS (
  SELECT DISTINCT doc_id, pos + step AS pos FROM late, (SELECT unnest(range(20)) AS step)
), marked AS (
  SELECT doc_id, list(pos) AS pos FROM gone GROUP BY doc_id
)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(len(m.pos), 0) AS n_removed,
  sha256(array_to_string(CASE WHEN m.pos IS NULL THEN w.w ELSE list_filter(w.w, lambda x, i: NOT list_contains(m.pos, i - 1)) END, ' ')) AS kept_sha256
FROM words w LEFT JOIN marked m ON m.doc_id = w.doc_id
"""
