"""Phrase collocations: contiguous word sequences that occur far more often than their parts would by chance.

Phrases grow level by level. The frequent phrases of one length form double-array tries of bounded size that are broadcast;
numpy moves the states of all text positions through a trie at once, one word after another. By the Apriori rule a longer
phrase can be frequent only where the frequent phrase at a position has another frequent one right beside it, so pairs of
accepting states that lie side by side in the text are the candidates. Each task counts its candidates, Spark sums them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import discard, map_batches, stored

#: A separator is never part of a word, so it can stand in the stream of words for the end of a piece.
_SEPARATORS, _END = r"[.,;:!?\x0a-\x0d]+", "."
#: Text that is split at once, pairs that a task counts at once, and rows that it hands over at once.
_SLICE_BYTES, _PAIRS_AT_ONCE, _ROWS_AT_ONCE = 2 << 20, 2_000_000, 100_000
_FOUND = "lang string, rank int, phrase string, a long, l long, r long, n long, score long"
_BLOCKED = 8  # a node with children at an eighth of all digits, or more, gets a block of slots of its own


class DoubleArray:
    """A trie over phrases of one length; each word id is two digits, so that no node has more than ``2 ** bits`` children.

    ``base[s] + digit`` is the slot of the child of slot ``s``, if ``check`` of that slot is ``s``. The root is slot 0.
    """

    def __init__(self, phrases: np.ndarray, values: np.ndarray) -> None:
        """``phrases`` is a matrix of positive word ids, a row for a phrase; ``values`` are positive numbers of the rows."""
        self.words = phrases.shape[1]
        self.bits = max(1, (int(phrases.max(initial=1)).bit_length() + 1) // 2)
        self.radix = 1 << self.bits
        self.base, self.check = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._grow(4 * self.radix)
        self.check[0] = -2
        self.end, random = 1, np.random.default_rng(1)
        digits = np.stack((phrases >> self.bits, phrases & (self.radix - 1)), axis=2).reshape(len(phrases), 2 * self.words)
        slots = np.zeros(len(phrases), np.int64)
        for column in digits.T if len(phrases) else ():
            edges, inverse = np.unique(slots * self.radix + column, return_inverse=True)
            slots = self._place(edges // self.radix, edges % self.radix, random)[inverse]
        self.value = np.zeros(len(self.base), np.int32)
        self.value[slots] = values
        self.base, self.check = self.base.astype(np.int32), self.check.astype(np.int32)

    def _grow(self, slots: int) -> None:
        more = slots - len(self.base)
        if more > 0:
            self.base = np.concatenate((self.base, np.zeros(more, np.int64)))
            self.check = np.concatenate((self.check, np.full(more, -1)))

    def _place(self, parents: np.ndarray, digits: np.ndarray, random: np.random.Generator) -> np.ndarray:
        """Slots of the children of ``parents`` (sorted) at ``digits``: bases are tried for all open nodes at once."""
        nodes, first, size = np.unique(parents, return_index=True, return_counts=True)
        node = np.repeat(np.arange(len(nodes)), size)
        base = np.full(len(nodes), -1)
        large = np.flatnonzero(size >= max(2, self.radix // _BLOCKED))
        base[large] = self.end + np.arange(len(large)) * self.radix
        self.end += len(large) * self.radix
        open_nodes = np.flatnonzero(base < 0)
        room = max(self.end, int((self.check != -1).sum()) + 3 * int(size[open_nodes].sum())) + self.radix
        self._grow(room + self.radix)
        chosen = np.zeros(len(nodes), bool)
        chosen[large] = True
        self.check[(base[node] + digits)[chosen[node]]] = parents[chosen[node]]
        tries = 0
        while len(open_nodes):
            base[open_nodes] = random.integers(1, room, len(open_nodes))
            waiting = np.flatnonzero(~chosen[node])
            slots = base[node[waiting]] + digits[waiting]
            _, winner = np.unique(slots, return_index=True)
            lost = np.ones(len(waiting), bool)
            lost[winner] = False
            lost |= self.check[slots] != -1
            failed = np.bincount(node[waiting][lost], minlength=len(nodes)) > 0
            placed = ~failed[node[waiting]]
            self.check[slots[placed]] = parents[waiting[placed]]
            chosen |= ~failed
            open_nodes = open_nodes[failed[open_nodes]]
            tries += 1
            if tries % 8 == 0:
                room += room // 2
                self._grow(room + self.radix)
        self.base[nodes] = base
        self.end = room + self.radix  # open nodes may have taken slots up to here
        return base[node] + digits

    def states(self, ids: np.ndarray) -> np.ndarray:
        """For every position of ``ids`` the value of the phrase that begins there, or 0."""
        out = np.zeros(len(ids), np.int32)
        at = np.flatnonzero(ids[: max(0, len(ids) - self.words + 1)])
        state = np.zeros(len(at), np.int32)
        for step in range(self.words):
            word = ids[at + step]
            for shift in (self.bits, 0):
                # A word beyond the trie's largest has too large a first digit, which is held to the arrays' bounds.
                digit = word >> shift if shift else word & (self.radix - 1)
                slot = self.base[state] + np.minimum(digit, self.radix)
                alive = (digit < self.radix) & (self.check[slot] == state)
                at, state, word = at[alive], slot[alive], word[alive]
        out[at] = self.value[state]
        return out


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The words of all texts in order, as indices into a list of different words; :data:`_END` ends a piece or text."""
    whole = texts.take(pa.array(np.arange(len(texts)))).cast(pa.large_string())  # a cast slice is lower-cased wrongly
    plain = pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(whole, "")), _SEPARATORS, " . ")
    end, blank = pa.scalar(_END, pa.large_string()), pa.scalar(" ", pa.large_string())
    ended = pc.binary_join_element_wise(plain, end, blank)
    parts = pc.ascii_split_whitespace(ended).flatten().dictionary_encode()
    indices = parts.indices.to_numpy(zero_copy_only=False)
    empty = parts.dictionary.index(pa.scalar("", pa.large_string())).as_py()
    return (indices[indices != empty] if empty >= 0 else indices), parts.dictionary


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    """Texts of one language at a time, about :data:`_SLICE_BYTES` together; a text is never cut."""
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        index = langs.indices.to_numpy(zero_copy_only=False)
        texts = pc.fill_null(batch.column("text"), "")
        for number, lang in enumerate(langs.dictionary.to_pylist()):
            own = texts.take(pa.array(np.flatnonzero(index == number)))
            part = np.cumsum(pc.binary_length(own).to_numpy(zero_copy_only=False).astype(np.int64)) // _SLICE_BYTES
            cuts = np.flatnonzero(np.diff(part)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(own)], strict=True):
                yield lang, own[start:stop]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, word, a`` of each slice; the row without a word has the number of all."""
    for lang, texts in _slices(batches):
        indices, words = words_of(texts)
        counts = np.bincount(indices, minlength=len(words))
        real = np.flatnonzero((counts > 0) & ~pc.equal(words, pa.scalar(_END, words.type)).to_numpy(zero_copy_only=False))
        names = pa.concat_arrays([words.take(pa.array(real)).cast(pa.string()), pa.nulls(1, pa.string())])
        numbers = pa.array(np.append(counts[real], counts[real].sum()).astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(names), pa.string()), names, numbers], ["lang", "word", "a"])


def _numbered(rows: DataFrame, order: list[str], most: int) -> tuple[DataFrame, int]:
    """The stored ``rows`` with ``shard`` and ``id`` from 1 without gaps, in shards of about ``most``; and how many shards.

    No rows have no shards.
    """
    shards = -(-rows.count() // most)
    if not shards:
        return rows.select("*", F.lit(0).alias("shard"), F.lit(0).alias("id")), 0
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64(*order), F.lit(shards)).cast("int"))
    sizes = {r["shard"]: r["count"] for r in dealt.groupBy("shard").count().collect()}
    before, total = [], 0
    for shard in range(shards):
        before.append(total)
        total += sizes.get(shard, 0)
    if total >= 1 << 31:
        raise ValueError("More than 2 ** 31 frequent phrases of one length")
    place = F.row_number().over(Window.partitionBy("shard").orderBy(*order))
    start = F.array(*map(F.lit, before))[F.col("shard")]
    return stored(dealt.withColumn("id", (start + place).cast("int")), "phrases"), shards


def _encode(vocabulary: Broadcast, last: bool):
    """Word ids of texts, 0 for ends of pieces and words that are not in this or an earlier part of the vocabulary."""

    def ids_of(lang: str, texts: pa.Array) -> np.ndarray:
        indices, words = words_of(texts)
        known, numbers = vocabulary.value.get(lang, (None, None))
        if known is None:
            return np.zeros(len(indices), np.int32)
        found = pc.index_in(words, value_set=known)
        ids = np.append(numbers, np.int32(0))[pc.fill_null(found, len(numbers)).to_numpy(zero_copy_only=False)]
        return ids.astype(np.int32)[indices]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        for batch in batches:
            if "texts" in batch.schema.names:
                for at in range(batch.num_rows):
                    lang, texts = batch.column("lang")[at].as_py(), batch.column("texts")[at].values
                    before = np.frombuffer(batch.column("ids")[at].as_buffer(), "<i4")
                    yield row(lang, texts, np.maximum(before, ids_of(lang, texts)))
            else:
                for lang, texts in _slices(iter([batch])):
                    yield row(lang, texts, ids_of(lang, texts))

    def row(lang: str, texts: pa.Array, ids: np.ndarray) -> pa.RecordBatch:
        ids = pa.array([ids.astype("<i4").tobytes()], pa.binary())
        if last:
            return pa.RecordBatch.from_arrays([ids], ["ids"])
        listed = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts.cast(pa.string()))
        return pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), listed, ids], ["lang", "texts", "ids"])

    return run


def _encoded(texts: DataFrame, vocabulary: DataFrame, shards: int) -> DataFrame:
    """``ids``: the texts as word ids, many texts to a row; a pass for each shard of the vocabulary, mostly one."""
    spark, rows = texts.sparkSession, texts
    for shard in range(shards):
        part = vocabulary.where(F.col("shard") == shard).select("lang", "word", "id").toArrow().combine_chunks()
        known = {}
        for lang in pc.unique(part["lang"]).to_pylist():
            own = part.filter(pc.equal(part["lang"], lang)).combine_chunks()
            known[lang] = own["word"].combine_chunks().cast(pa.large_string()), own["id"].to_numpy()
        sent, last = spark.sparkContext.broadcast(known), shard == shards - 1
        schema = "ids binary" if last else "lang string, texts array<string>, ids binary"
        done = stored(map_batches(rows, _encode(sent, last), schema), "encoded")
        if shard:
            discard(rows)
        sent.destroy()
        rows = done
    return rows


def _fill(trie: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, before in _positions(batch):
                states = np.maximum(before, trie.value.states(ids))
                columns = [pa.array([x.astype("<i4").tobytes()], pa.binary()) for x in (ids, states)]
                yield pa.RecordBatch.from_arrays(columns, ["ids", "states"])

    return run


def _positions(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray | int]]:
    for at in range(batch.num_rows):
        ids = np.frombuffer(batch.column("ids")[at].as_buffer(), "<i4")
        yield ids, np.frombuffer(batch.column("states")[at].as_buffer(), "<i4") if "states" in batch.schema.names else 0


def _count_pairs(trie: Broadcast | None):
    """``pair, a``: accepting states beside each other, counted; a pair is the two in one number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for ids, before in _positions(batch):
                states = ids if trie is None else np.maximum(before, trie.value.states(ids))
                at = np.flatnonzero((states[:-1] > 0) & (states[1:] > 0))
                held.append((states[at].astype(np.int64) << 32) | states[at + 1])
                size += len(at)
                if size >= _PAIRS_AT_ONCE:
                    yield from counted(held)
                    held, size = [], 0
        if size:
            yield from counted(held)

    def counted(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.unique(np.concatenate(held), return_counts=True)
        for start in range(0, len(pairs), _ROWS_AT_ONCE):
            part = slice(start, start + _ROWS_AT_ONCE)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[part]), pa.array(counts[part].astype(np.int64))], ["pair", "a"])

    return run


def _pairs(encoded: DataFrame, known: DataFrame, shards: int, words: int, min_count: int) -> DataFrame:
    """``left, right, a``: frequent phrases of ``words + 1`` words by their first and their last ``words`` words."""
    spark, rows, sent = encoded.sparkSession, encoded, []
    trie = None
    for shard in range(shards) if words > 1 else ():
        part = known.where(F.col("shard") == shard).select("id", *(F.col("words")[i].alias(f"w{i}") for i in range(words)))
        part = part.toArrow()
        matrix = np.stack([part[f"w{i}"].to_numpy() for i in range(words)], axis=1).astype(np.int64)
        trie = spark.sparkContext.broadcast(DoubleArray(matrix, part["id"].to_numpy()))
        sent.append(trie)
        if shard < shards - 1:
            filled = stored(map_batches(rows, _fill(trie), "ids binary, states binary"), "states")
            if shard:
                discard(rows)
            rows = filled
    pairs = map_batches(rows, _count_pairs(trie), "pair long, a long").groupBy("pair").agg(F.sum("a").alias("a"))
    left, right = F.shiftright("pair", 32).cast("int"), F.col("pair").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
    frequent = stored(
        pairs.where(F.col("a") >= min_count).select(left.alias("left"), right.alias("right"), "a"), "pairs"
    )
    if rows is not encoded:
        discard(rows)
    for trie in sent:
        trie.destroy()
    return frequent


def _longer(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The phrases that ``pairs`` of known phrases make; ``heads`` and ``tails`` count their first and last 1, 2, ... words."""
    first = known.select(F.col("id").alias("left"), "lang", "words", "heads")
    last = known.select(F.col("id").alias("right"), F.element_at("words", -1).alias("word"), "tails")
    return pairs.join(first, "left").join(last, "right").select(
        "lang",
        F.array_append("words", F.col("word")).alias("words"),
        "a",
        F.array_append("heads", F.col("a")).alias("heads"),
        F.array_append("tails", F.col("a")).alias("tails"),
        "left",
        "right",
    )


def _lowest_cut(words: int) -> Column:
    """``score, l, r`` of the lowest-scoring cut; of equal ones the first. Products are decimals of 38 digits."""
    cuts = []
    for k in range(1, words):
        left, right = f"heads[{k - 1}]", f"tails[{words - k - 1}]"
        over = "CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(15,0)) * CAST(n AS DECIMAL(17,0))"
        under = f"(CAST({left} AS DECIMAL(18,0)) * CAST({right} AS DECIMAL(18,0)))"
        score = F.expr(f"({over}) div {under}").alias("score")
        cuts.append(F.struct(score, F.lit(k).alias("k"), F.expr(left).alias("l"), F.expr(right).alias("r")))
    return F.array_min(F.array(*cuts))


def collocations(
    docs: DataFrame,
    max_words: int = 5,
    min_count: int = 100,
    best: int = 2000,
    contained_percent: int = 100,
    max_vocabulary: int = 1_000_000,
    max_phrases: int = 500_000,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``best`` phrases of 2 to ``max_words`` words of every language.

    A-Z are lower-cased; texts end and are cut into pieces at ``. , ; : ! ?`` and line ends; words are parted by blanks and
    tabs. A phrase counts where its words stand together within a piece, ``a`` times, overlaps included; ``n`` is the number
    of words of the language. Phrases with ``a`` of ``min_count`` are candidates. One cut into two parts that occur ``l`` and
    ``r`` times scores ``floor(1000 * a * n / (l * r))``; the lowest cut counts. A candidate goes if a longer one that
    contains it has ``contained_percent`` of its count or more. Ties go to the greater ``a``, then to the phrase's bytes.

    ``max_vocabulary`` and ``max_phrases`` bound what is broadcast at once: more frequent words or phrases take more passes,
    with the same result. Null texts are empty, a null language is ``und``; null ids and repeated rows are rows like any
    other; texts of any length are read whole; other columns are ignored; empty tables, or too few words, give no rows.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    counted = map_batches(texts, _count_words, "lang string, word string, a long").groupBy("lang", "word").agg(F.sum("a").alias("a"))
    words = stored(counted.where((F.col("a") >= min_count) | F.col("word").isNull()), "words")
    totals = words.where("word IS NULL").select("lang", F.col("a").alias("n"))
    vocabulary, shards = _numbered(words.where("word IS NOT NULL"), ["lang", "word"], max_vocabulary)
    levels = [
        vocabulary.select(
            "id", "lang", "a", F.array("id").alias("words"), F.array("a").alias("heads"), F.array("a").alias("tails"), "shard"
        )
    ]
    if shards:
        encoded = _encoded(texts, vocabulary, shards)
        while shards and len(levels) < max_words:
            pairs = _pairs(encoded, levels[-1], shards, len(levels), min_count)
            longer = stored(_longer(pairs, levels[-1]), "longer")
            known, shards = _numbered(longer, ["lang", "words"], max_phrases)
            levels.append(known)
        discard(encoded)
    found = None
    for length, level in enumerate(levels[1:], 2):
        if length < len(levels):
            over = levels[length]
            over = over.select(F.col("left").alias("id"), F.col("a").alias("most")).unionByName(
                over.select(F.col("right").alias("id"), F.col("a").alias("most"))
            )
            level = level.join(over.groupBy("id").agg(F.max("most").alias("most")), "id", "left").where(
                F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * contained_percent)
            )
        cut = level.join(totals, "lang").withColumn("cut", _lowest_cut(length))
        cut = cut.select("lang", "words", "a", "cut.l", "cut.r", "n", "cut.score")
        found = cut if found is None else found.unionByName(cut)
    if found is None:
        return docs.sparkSession.createDataFrame([], _FOUND)
    # Phrases of equal score and count are told apart by their text, so all that may be among the best are spelled out.
    bound = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    short = found.withColumn("place", F.rank().over(bound)).where(F.col("place") <= best).drop("place")
    spelled = stored(short.withColumn("row", F.monotonically_increasing_id()), "best")
    named = vocabulary.select("id", "word")
    parts = spelled.select("row", F.posexplode("words").alias("pos", "id")).join(named, "id")
    phrase = parts.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("parts"))
    phrase = phrase.select("row", F.array_join("parts.word", " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = spelled.join(phrase, "row").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
