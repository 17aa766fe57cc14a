"""Spelling variants: words that differ by one letter from a far more frequent one.

The vocabulary is searched with a bidirectional FM-index. Words stand between delimiters in one text;
a pattern that occurs in it has an interval of suffix ranks in the index of the text and one in the
index of the reversed text, and a step in either keeps both in agreement. A word with one error
has one of its halves in common with the word it is near to. The search scheme "first" matches
delimiter and first half exactly, from the inside out, then turns round and extends over the second half
allowing one insertion, deletion or replacement up to the delimiter; the scheme "last" is its mirror image.

Dealing. Words of six letters or more have halves of three or more, so a word and its near words share
the first three letters or the last three. For each scheme words go to shards by those three letters; a
frequent three-letter key is split into parts, each indexing some of its words and asked by all of them.
So a shard is bounded and no two words meet that share neither end.

Defined cases: null and empty texts have no words; a null id is hashed as an empty one; repeated rows count
each; other columns are not looked at; an empty table gives an empty one. Texts and words of any
length are taken whole (a step is one letter, so a shard takes as many steps as its longest word has).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelkit.llm.registry import query, table
from panelkit.session import store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LETTERS, MIN_COUNT, RATIO, NOISE = 6, 5, 5, 199
KEY = 3  # letters at an end that near words share
PART_WORDS = 4000  # words of one key in one index
SHARD_ROWS = 8000
SHARDS_A_TASK = 8
STATES = 1 << 14  # that are expanded at once; bounds the temporary arrays
STEP = 32  # ranks are stored at every so many places


# Counting

def words_of_texts(docs: DataFrame, id_col: str, text_col: str, min_letters: int, noise: int) -> DataFrame:
    """word: the runs of letters, A-Z lower-cased; one letter of every ``noise``-th (document, run) is deleted."""
    run = F.explode(F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{min_letters},}}+"), F.lit(0)))
    own = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    own = own.withColumn("run", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run")))
    h, size = F.crc32(F.concat_ws(":", "id", "run").cast("binary")), F.length("run")
    at = (h % size).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, size))
    return own.select(F.when(h % noise == 0, shorter).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, noise: int = NOISE) -> DataFrame:
    """word, n (its occurrences in all texts) of words long and frequent enough."""
    words = words_of_texts(docs, id_col, text_col, min_letters, noise).filter(F.length("word") >= min_letters)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


# The index

class Ranks:
    """Suffix ranks of one text: how often each symbol stands before a place of its last column."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.places = suffix_order(text)
        self.symbols = symbols
        before = text[self.places - 1]  # the last column; the text's end stands before its begin
        self.column = np.concatenate([before, np.zeros(STEP, before.dtype)])
        counts = np.bincount(text, minlength=symbols)
        self.first = np.cumsum(counts) - counts
        blocks = (len(text) + STEP) // STEP
        own = np.bincount(np.arange(len(text)) // STEP * symbols + before, minlength=blocks * symbols).reshape(blocks, symbols)
        self.stored = (np.cumsum(own, axis=0) - own).astype(np.int32)

    def _block(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of the place's block, and which of them stand before the place."""
        inside = np.arange(STEP)
        return self.column[(at - at % STEP)[:, None] + inside], inside < (at % STEP)[:, None]

    def count(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        block, before = self._block(at)
        return self.stored[at // STEP, symbol] + ((block == symbol[:, None]) & before).sum(axis=1)

    def count_below(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many smaller symbols stand before each place."""
        block, before = self._block(at)
        total = np.cumsum(self.stored[at // STEP], axis=1, dtype=np.int64)[np.arange(len(at)), symbol] - self.stored[at // STEP, symbol]
        return total + ((block < symbol[:, None]) & before).sum(axis=1)

    def count_all(self, at: np.ndarray) -> np.ndarray:
        """A row of counts, one for each symbol, for every place."""
        block, before = self._block(at)
        row = np.repeat(np.arange(len(at)), before.sum(axis=1))
        inside = np.bincount(row * self.symbols + block[before], minlength=len(at) * self.symbols)
        return self.stored[at // STEP] + inside.reshape(len(at), self.symbols)

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.first[symbol] + self.count(symbol, low), self.first[symbol] + self.count(symbol, high)

    def children(self, low: np.ndarray, high: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Every extension by a symbol from ``least`` on: (state, symbol, low, high)."""
        out = []
        for at in range(0, len(low), STATES):
            a, b = self.count_all(low[at:at + STATES]), self.count_all(high[at:at + STATES])
            a[:, :least] = b[:, :least]
            state, symbol = np.nonzero(b > a)
            out.append((state + at, symbol, self.first[symbol] + a[state, symbol], self.first[symbol] + b[state, symbol]))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 4


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Places in the order of their suffixes, by doubling the compared length. The last symbol is the smallest and occurs once."""
    rank, width = text.astype(np.int64), 1
    while True:
        ahead = np.full(len(rank), -1, np.int64)
        ahead[:-width or None] = rank[width:]
        pair = rank * (int(rank.max()) + 2) + ahead + 1
        order = np.argsort(pair, kind="stable")
        rises = np.concatenate([[0], np.cumsum(pair[order][1:] != pair[order][:-1])])
        rank = np.empty_like(rank)
        rank[order] = rises
        if rises[-1] == len(rank) - 1:
            return order
        width *= 2


END, BORDER = 0, 1  # symbols: the text's end, the delimiter; letters follow


class Shard:
    """A bidirectional index of words, and the patterns that are looked for in it."""

    def __init__(self, codes: np.ndarray, sizes: np.ndarray, indexed: np.ndarray):
        letters, symbol = np.unique(codes, return_inverse=True)
        self.letters = len(letters) + 2
        self.symbol = (symbol + 2).astype(np.uint8 if self.letters < 256 else np.uint32)
        self.start, self.size = np.cumsum(sizes) - sizes, sizes
        parts = [np.array([BORDER], self.symbol.dtype)]
        for word in np.flatnonzero(indexed):
            parts += [self.symbol[self.start[word]:self.start[word] + sizes[word]], parts[0]]
        text = np.concatenate(parts)
        self.borders, self.words = np.flatnonzero(text == BORDER), np.flatnonzero(indexed)
        end = np.array([END], text.dtype)
        self.length = len(text)
        self.ahead, self.behind = Ranks(np.concatenate([text, end]), self.letters), Ranks(np.concatenate([text[::-1], end]), self.letters)

    def near(self, mirrored: bool) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, word): each pair with exactly one error between them, that one half of the pattern does not see."""
        exact, error = (self.behind, self.ahead) if mirrored else (self.ahead, self.behind)
        half = self.size - self.size // 2 if mirrored else self.size // 2

        def letter(pattern, at):
            """The at-th letter seen from the exact half's end."""
            return self.symbol[self.start[pattern] + (self.size[pattern] - 1 - at if mirrored else at)].astype(np.int64)

        # The exact half from the inside out and the delimiter, in one index; the other's interval follows.
        n = len(self.size)
        low, high, other = np.zeros(n, np.int64), np.full(n, self.length + 1), np.zeros(n, np.int64)
        live = np.arange(n)
        for done in range(int(half.max(initial=0)) + 1):
            live = live[(half[live] >= done) & (high[live] > low[live])]
            symbol = np.full(len(live), BORDER, np.int64)
            inner = half[live] > done
            symbol[inner] = letter(live[inner], half[live[inner]] - 1 - done)
            other[live] += exact.count_below(symbol, high[live]) - exact.count_below(symbol, low[live])
            low[live], high[live] = exact.extend(low[live], high[live], symbol)
        found = np.flatnonzero(high > low)
        # Turn round: (pattern, letters seen, interval) without an error, and with one.
        pattern, at, a, b = found, half[found], other[found], other[found] + high[found] - low[found]
        wrong = [np.zeros(0, np.int64)] * 4
        pairs = []
        while len(pattern) or len(wrong[0]):
            more = at < self.size[pattern]
            child, symbol, c_low, c_high = error.children(a, b, BORDER + 1)
            here = np.full(len(pattern), -1, np.int64)
            here[more] = letter(pattern[more], at[more])
            differs = more[child] & (symbol != here[child])
            wrong = [np.concatenate(x) for x in zip(
                wrong,
                (pattern[child], at[child], c_low, c_high),  # an inserted letter
                (pattern[child[differs]], at[child[differs]] + 1, c_low[differs], c_high[differs]),  # a replaced one
                (pattern[more], at[more] + 1, a[more], b[more]),  # one left out
            )]
            a, b, same = a[more], b[more], here[more]
            pattern, at = pattern[more], at[more] + 1
            a, b = error.extend(a, b, same)
            kept = b > a
            pattern, at, a, b = pattern[kept], at[kept], a[kept], b[kept]

            p, seen, c, d = wrong
            whole = seen >= self.size[p]
            symbol = np.full(len(p), BORDER, np.int64)
            symbol[~whole] = letter(p[~whole], seen[~whole])
            c, d = error.extend(c, d, symbol)
            kept = d > c
            ended = kept & whole
            pairs.append((p[ended], c[ended]))  # delimiter, word, delimiter: one place only
            kept &= ~whole
            wrong = [p[kept], seen[kept] + 1, c[kept], d[kept]]
        pattern, rank = (np.concatenate(x) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
        place = error.places[rank]
        border = np.searchsorted(self.borders, place if mirrored else self.length - 1 - place)
        word = self.words[border if mirrored else border - 1]
        both = np.unique(np.stack([pattern, word], axis=1), axis=0)
        both = both[both[:, 0] != both[:, 1]]
        return both[:, 0], both[:, 1]

    def begins_alike(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Whether ``other`` begins with the first half of ``one``."""
        half, out = self.size[one] // 2, self.size[other] >= self.size[one] // 2
        for at in range(int(half.max(initial=0))):
            live = np.flatnonzero(out & (half > at))
            out[live] = self.symbol[self.start[one[live]] + at] == self.symbol[self.start[other[live]] + at]
        return out


def near_in_shard(rows: pa.Table) -> pa.Table:
    """word, n_near, best (the near word of largest n) and its n, for the words of one shard that have any."""
    rows = rows.take(pc.sort_indices(rows, sort_keys=[("word", "ascending"), ("indexed", "descending")]))
    mirrored = rows["mirrored"][0].as_py()
    words = rows["word"].combine_chunks() if isinstance(rows["word"], pa.ChunkedArray) else rows["word"]
    words = pa.concat_arrays(words.chunks) if isinstance(words, pa.ChunkedArray) else words
    fresh = np.ones(len(words), bool)  # a word that asks several parts of one shard asks once
    fresh[1:] = pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False)
    rows, words = rows.filter(pa.array(fresh)), words.filter(pa.array(fresh))
    n, indexed = rows["n"].to_numpy(), rows["indexed"].to_numpy(zero_copy_only=False)
    codes = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
    shard = Shard(codes, pc.utf8_length(words).to_numpy().astype(np.int64), indexed)
    one, other = shard.near(mirrored)
    if mirrored:  # the other scheme finds those that share the first half
        fresh = ~shard.begins_alike(one, other)
        one, other = one[fresh], other[fresh]
    order = np.lexsort([other, -n[other], one])  # words are sorted, so numbers are in their order
    one, other = one[order], other[order]
    first = np.flatnonzero(np.concatenate([[True], one[1:] != one[:-1]])[:len(one)])
    near = np.diff(np.append(first, len(one)))
    return pa.table({
        "word": words.take(pa.array(one[first])), "n_near": pa.array(near, pa.int64()),
        "best": words.take(pa.array(other[first])), "best_n": pa.array(n[other[first]], pa.int64()),
    })


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, best, best_n of words that have near ones. ``words``: a stored table of distinct word, n."""
    ends = F.explode(F.array(*[F.struct(F.lit(side).alias("mirrored"), key.alias("key")) for side, key in (
        (False, F.substring("word", 1, KEY)), (True, F.substring("word", -KEY, KEY)))]))
    dealt = words.select("word", "n", ends.alias("end")).select("word", "n", "end.*")
    hot = dealt.groupBy("mirrored", "key").agg(F.ceil(F.count(F.lit(1)) / PART_WORDS).cast("int").alias("parts")).filter("parts > 1")
    dealt = dealt.join(store(hot, "hot_ends"), ["mirrored", "key"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    dealt = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    least = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = int(max(least, 2 * words.count() // SHARD_ROWS))
    shard = F.pmod(F.xxhash64("key", "part"), F.lit(shards)).cast("int")
    dealt = dealt.select(shard.alias("shard"), "mirrored", "word", "n", (F.col("part") == own).alias("indexed"))
    dealt = dealt.repartition(max(least, shards // SHARDS_A_TASK), "shard", "mirrored")  # few bytes, much work: not to be put together
    found = dealt.groupBy("shard", "mirrored").applyInArrow(near_in_shard, "word string, n_near long, best string, best_n long")
    first = F.min(F.struct((-F.col("best_n")).alias("order"), F.col("best"))).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first).select("word", "n_near", "first.best", (-F.col("first.order")).alias("best_n"))


def follow(links: DataFrame) -> DataFrame:
    """word, root: the last of the forms that follow each other. Forms grow in n, so there are no rings.

    Each round takes the root of the root, so rounds grow with the logarithm of the longest chain.
    """
    roots = store(links.toDF("word", "root"), "roots")
    while True:
        ahead = roots.toDF("root", "beyond")
        step = store(roots.join(ahead, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        roots = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return roots


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word of six letters or more, n; distinct)."""
    words = store(words.select("word", F.col("n").cast("long").alias("n")), "vocabulary")
    found = words.join(near_words(words), "word", "left")
    is_form: Column = F.col("best_n") >= ratio * F.col("n")
    found = store(found.select("word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n")), "forms")
    roots = follow(found.filter("form IS NOT NULL").select("word", "form"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b::BIGINT) ORDER BY b) AS t FROM range(256) r(b)),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS doc_id,
           translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  GROUP BY ALL HAVING length(run) >= 6),
hashed AS (
  SELECT run, n, xor(list_reduce(list_transform(range(length(hex(encode(doc_id || ':' || run))) // 2), lambda i: ('0x' || substr(hex(encode(doc_id || ':' || run)), 2 * i::INT + 1, 2))::BIGINT),
                                 lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS h FROM runs, crc_table),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY ALL),
v AS MATERIALIZED (SELECT word, n FROM words WHERE length(word) >= 6 AND n >= 5),
gaps AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i::INT - 1) || substr(word, i::INT + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM gaps a JOIN gaps b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gaps a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM gaps a JOIN v b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * v.n THEN other END AS form, CASE WHEN other_n >= 5 * v.n THEN other_n END AS form_n
  FROM v LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS last, form AS next FROM forms
  UNION ALL SELECT chain.word, chain.next, forms.form FROM chain JOIN forms ON chain.next = forms.word)
SELECT forms.word, form, last AS root, n, n_near::BIGINT AS n_near, form_n FROM forms JOIN chain ON forms.word = chain.word AND chain.next IS NULL"""


@query("op11_spelling_variants", SQL)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its near words, the form it is a variant of, and the form's own root."""
    return spelling_variants(vocabulary(table(spark, sf_dir, "documents")))
