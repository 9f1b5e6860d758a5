"""Spelling variants by a trie over frequency vectors of words.

* A word is the vector of how often it has each of `GROUPS` groups of letters. One inserted,
  deleted or replaced letter moves one count up, one down, or one up and another down: a near
  word's vector is found with a surplus and a deficit of one each.
* The trie parts words by one group's count after the other. Its upper levels are keys of
  Spark: all words and all searches go down `STEP` levels a round, a search to every node
  that its budget reaches; nodes of over `NODE` words are opened by the next round. So a node
  is as deep as its words ask for, at every size of the vocabulary.
* A task builds the trie of a node's words and walks it depth first with some searches at a
  time, each spending what is left of its budget. Words of the leaves that it reaches are
  verified letter by letter. No pair leaves a task: a search returns the number of near words
  and the largest of them.
* Hot nodes: searches of a node are dealt in slices of `SLICE`, and what is still over `NODE`
  words below the last level in blocks; every slice meets every block. Words are counted by a
  partial aggregate before any shuffle; long words count for more in these bounds.

Nulls and ties: a null text has no words, a null doc_id is hashed as the text 'null'. Of near
words of equal count the first in code-point order is the form. Rows that repeat count as
often as they are there. An empty table, or texts without words, give no rows; further
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import bytes_of, owners, written

LEAST_LENGTH = 7
LEAST_N = 2
TIMES = 10      # a form is at least so much more frequent
TYPO = 31       # one run in so many loses a letter
GROUPS = 16
STEP = 2
NODE = 16384
SLICE = 65536
WIDE = 48       # letters; longer words are verified one by one
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_USUAL = "etaoinsrhldcumfpgwybvkxjqz"
_MOST = 250     # counts above are one; it keeps differences of one at one or less
_LATIN = "ISO-8859-1"
_SEARCHES, _FRONT, _PAIRS = 4096, 1 << 18, 1 << 19


def group_of(letter: str) -> int:
    """Usual letters have a group of their own, the rarest share one with them; other letters are dealt by code point."""
    if letter in _USUAL:
        at = _USUAL.index(letter)
        return at if at < GROUPS else 2 * GROUPS - 1 - at
    return ord(letter) % GROUPS


_LETTERS = [*_LOWER, *map(chr, range(0xC0, 0x100))]
_GROUP = np.array([group_of(chr(i)) for i in range(256)])


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_n: int = LEAST_N, typo: int = TYPO) -> DataFrame:
    """(word, n): runs of letters of all texts in lower case, of which one in `typo` by hash loses a letter."""
    # shorter runs can't give a word; a maximal run is matched whole
    runs = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(f"[a-zÀ-ÿ]{{{max(least_length, 1)},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("doc"), F.explode(runs).alias("run"))
    rows = rows.select("run", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % typo == 0, cut).otherwise(F.col("run"))
    return (rows.select(word.alias("word")).where(F.length("word") >= least_length)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n))


def counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Frequency vectors of words in a row."""
    n = len(at) - 1
    found = np.bincount(owners(at) * GROUPS + _GROUP[data], minlength=n * GROUPS)
    return np.minimum(found, _MOST).astype(np.int16).reshape(n, GROUPS)


class Trie:
    """Frequency vectors parted by one count after the other; a leaf holds the words of one vector."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.lexsort(vectors.T[::-1])
        along = vectors[self.order]
        node, self.children = np.zeros(len(along), dtype=np.int64), []
        for level in range(GROUPS):
            width = int(along[:, level].max(initial=0)) + 3  # a column for -1 before, one for all that is above behind
            key = node * width + along[:, level] + 1
            first = np.concatenate([[True], key[1:] != key[:-1]])
            table = np.full((int(node[-1]) + 1) * width, -1, dtype=np.int32)
            node = np.cumsum(first) - 1
            table[key[first]] = node[first]
            self.children.append(table.reshape(-1, width))
        self.leaves = np.append(np.flatnonzero(first), len(along))  # where each begins in `order`

    def walk(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(search, leaf) pairs within a surplus and a deficit of one, depth first, many searches at a time."""
        n = len(vectors)
        stack = [(0, np.arange(n), np.zeros(n, dtype=np.int32), np.ones(n, dtype=bool), np.ones(n, dtype=bool))]
        while stack:
            level, search, node, surplus, deficit = stack.pop()
            if level == GROUPS:
                yield search, node
                continue
            table = self.children[level]
            column = vectors[search, level].astype(np.int64) + 1
            parts = []
            for move, may in ((0, None), (1, surplus), (-1, deficit)):
                have = np.arange(len(search)) if may is None else np.flatnonzero(may)
                child = table[node[have], np.minimum(column[have] + move, table.shape[1] - 1)]
                have, child = have[child >= 0], child[child >= 0]
                parts.append((search[have], child, surplus[have] & (move <= 0), deficit[have] & (move >= 0)))
            front = [np.concatenate(x) for x in zip(*parts)]
            for start in range(0, len(front[0]), _FRONT):
                stack.append((level + 1, *(x[start:start + _FRONT] for x in front)))


def one_edit(a: bytes, b: bytes) -> bool:
    """Exactly one letter inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(a) == len(b):
        return int((x != y).sum()) == 1
    differ = np.flatnonzero(x != y[:-1])
    at = int(differ[0]) if len(differ) else len(a)
    return bool((x[at:] == y[at + 1:]).all())


class Words:
    """Words as rows of a matrix, with what tells most unlike ones apart at once."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.data, self.at, self.size = data, at, np.diff(at)
        self.matrix = np.zeros((len(self.size), WIDE), dtype=np.uint8)
        row, place = owners(at), np.arange(len(data)) - np.repeat(at[:-1], self.size)
        inside = place < WIDE
        self.matrix[row[inside], place[inside]] = data[inside]
        behind = np.repeat(self.size, self.size) - 1 - place
        self.head, self.tail = np.zeros((2, len(self.size)), dtype=np.int32)
        for k in range(3):  # one edit leaves the first three letters or the last three alone, from seven letters up
            np.add.at(self.head, row[place == k], data[place == k].astype(np.int32) << 8 * k)
            np.add.at(self.tail, row[behind == k], data[behind == k].astype(np.int32) << 8 * k)

    def cell(self, i: int) -> bytes:
        return self.data[self.at[i]:self.at[i + 1]].tobytes()


def near(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Which pairs (a[i], b[j]) are one edit apart."""
    out = np.zeros(len(i), dtype=bool)
    some = ((a.head[i] == b.head[j]) | (a.tail[i] == b.tail[j])) & (np.abs(a.size[i] - b.size[j]) <= 1)
    some |= np.minimum(a.size[i], b.size[j]) < 6  # the ends may overlap
    wide = some & (np.maximum(a.size[i], b.size[j]) > WIDE)
    for at in np.flatnonzero(wide):
        out[at] = one_edit(a.cell(i[at]), b.cell(j[at]))
    some &= ~wide
    same = np.flatnonzero(some & (a.size[i] == b.size[j]))
    out[same] = (a.matrix[i[same]] != b.matrix[j[same]]).sum(axis=1) == 1
    for shorter, longer, x, y in ((a, b, i, j), (b, a, j, i)):
        rows = np.flatnonzero(some & (longer.size[y] == shorter.size[x] + 1))
        s, t = shorter.matrix[x[rows]], longer.matrix[y[rows]]
        first = (s != t).argmax(axis=1)  # there is one, as a letter of the longer meets none
        moved = s[:, :-1] != t[:, 1:]
        last = np.where(moved.any(axis=1), moved.shape[1] - 1 - moved[:, ::-1].argmax(axis=1), -1)
        out[rows] = last < first
    return out


def search(words: tuple[np.ndarray, np.ndarray], n: np.ndarray, searches: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(number of near words, the largest one or -1) of each search."""
    total, best = np.zeros(len(searches[1]) - 1, dtype=np.int64), np.full(len(searches[1]) - 1, -1, dtype=np.int64)
    if not len(n) or not len(total):
        return total, best
    own, asked = Words(*words), Words(*searches)
    by_size = np.array(sorted(range(len(n)), key=lambda k: (-n[k], own.cell(k))))
    rank = np.empty(len(n), dtype=np.int64)
    rank[by_size] = np.arange(len(n))
    trie, vectors = Trie(counts(*words)), counts(*searches)
    least = np.full(len(total), len(n), dtype=np.int64)
    for start in range(0, len(total), _SEARCHES):
        for which, leaf in trie.walk(vectors[start:start + _SEARCHES]):
            held = trie.leaves[leaf + 1] - trie.leaves[leaf]
            # some pairs at a time, and a leaf's words in stretches
            for a, b in _stretches(held):
                size = np.minimum(held[a:b], _PAIRS)
                for lift in range(0, int(held[a:b].max()), _PAIRS):
                    size = np.clip(held[a:b] - lift, 0, _PAIRS)
                    i = np.repeat(which[a:b], size) + start
                    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                    j = trie.order[np.repeat(trie.leaves[leaf[a:b]], size) + lift + step]
                    hit = near(asked, i, own, j)
                    total += np.bincount(i[hit], minlength=len(total))
                    np.minimum.at(least, i[hit], rank[j[hit]])
    found = least < len(n)
    best[found] = by_size[least[found]]
    return total, best


def _stretches(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows that have about _PAIRS together, one row at least."""
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // _PAIRS)) + 1
    yield from zip([0, *cuts], [*cuts, len(sizes)]) if len(sizes) else ()


def _count(word: str, group: int) -> Column:
    letters = "".join(x for x in _LETTERS if group_of(x) == group)
    return F.least(F.length(word) - F.length(F.translate(word, letters, "")), F.lit(_MOST))


def _moves() -> Column:
    """What a search may add to the STEP counts of a round, with its cost."""
    out = []
    for move in product((0, 1, -1), repeat=STEP):
        up, down = sum(x == 1 for x in move), sum(x == -1 for x in move)
        if up <= 1 and down <= 1:
            delta = sum(x << 8 * k for k, x in enumerate(move))
            out.append(F.struct(F.lit(delta).alias("delta"), F.lit(up).alias("up"), F.lit(down).alias("down")))
    return F.array(*out)


def _near_words(words: DataFrame, node: int, slice_: int) -> DataFrame:
    """(word, n_near, best): of every word that has a near one; best is a struct of -n and the word."""
    size = F.lit(1) + F.floor(F.length("word") / 256)
    held = words.select("word", "n", F.lit("").alias("path"))
    asked = words.select("word", F.lit("").alias("path"), F.lit(1).alias("up"), F.lit(1).alias("down"))
    found = []
    for level in range(0, GROUPS, STEP):
        packed = sum((_count("word", level + k) * (1 << 8 * k) for k in range(STEP)), F.lit(0))
        held = written(held.select("word", "n", F.concat_ws("/", "path", packed).alias("path")), "nodes")
        last = level + STEP >= GROUPS
        nodes = held.groupBy("path").agg(F.sum(size).alias("held"))
        move = F.explode(F.filter(_moves(), lambda m: (m["up"] <= F.col("up")) & (m["down"] <= F.col("down"))))
        moved = asked.withColumn("move", move).select(
            "word", F.concat_ws("/", "path", packed + F.col("move.delta")).alias("path"),
            (F.col("up") - F.col("move.up")).alias("up"), (F.col("down") - F.col("move.down")).alias("down"))
        nodes = written(nodes.withColumn("open", (F.col("held") > node) & ~F.lit(last)), "plan")
        asked = written(moved.join(nodes.select("path", "open"), "path"), "searches")
        slices = (asked.where("NOT open").groupBy("path").agg(F.ceil(F.sum(size) / slice_).alias("slices"))
                  .join(nodes.select("path", F.ceil(F.col("held") / node).alias("blocks")), "path"))
        plan = written(slices, "slices")
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
        mine = lambda n: F.pmod(F.xxhash64("word"), F.col(n))
        given = held.join(plan, "path").withColumn("block", mine("blocks")).withColumn("slice", every("slices"))
        wanted = asked.where("NOT open").join(plan, "path").withColumn("slice", mine("slices")).withColumn("block", every("blocks"))
        cell = F.encode("word", _LATIN).alias("word")
        rows = (given.select("path", "block", "slice", cell, "n").unionByName(wanted.select("path", "block", "slice", cell, F.lit(0).cast("bigint").alias("n"))))
        found.append(written(rows.groupBy("path", "block", "slice").applyInArrow(_search_node, "word binary, n_near bigint, best_n bigint, best binary"), "near"))
        opened = nodes.where("open")
        if last or opened.isEmpty():
            break
        held = held.join(opened.select("path"), "path", "left_semi")
        asked = asked.where("open").drop("open")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    best = F.min(F.struct(-F.col("best_n"), F.col("best"))).alias("best")
    return out.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        F.decode("word", _LATIN).alias("word"), "n_near", (-F.col("best.col1")).alias("best_n"), F.decode("best.best", _LATIN).alias("best"))


def _search_node(table: pa.Table) -> pa.Table:
    """Near words of a node's searches; words have a count, searches none."""
    table = table.combine_chunks()
    n = table["n"].to_numpy()
    word = table["word"].combine_chunks() if table.num_rows else pa.array([], pa.binary())
    word = word.chunk(0) if isinstance(word, pa.ChunkedArray) else word
    own, asks = word.filter(pa.array(n > 0)), word.filter(pa.array(n == 0))
    total, best = search(bytes_of(own), n[n > 0], bytes_of(asks))
    hit = np.flatnonzero(total)
    place = pa.array(best[hit])
    return pa.table({"word": asks.take(pa.array(hit)).cast(pa.binary()), "n_near": pa.array(total[hit]),
                     "best_n": pa.array(n[n > 0][best[hit]]), "best": own.take(place).cast(pa.binary())})


def variants(words: DataFrame, times: int = TIMES, node: int = NODE, slice_: int = SLICE) -> DataFrame:
    """word, form, root, n, n_near and form_n for every row of `words` (word of Latin-1 letters, n > 0; each word once)."""
    words = written(words.select("word", F.col("n").cast("bigint").alias("n")), "words")
    found = _near_words(words, node, slice_).alias("f")
    is_form = F.col("f.best_n") >= F.col("w.n") * times
    out = written(words.alias("w").join(found, F.col("w.word") == F.col("f.word"), "left").select(
        "w.word", F.when(is_form, F.col("f.best")).alias("form"), "w.n", F.coalesce("f.n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, F.col("f.best_n")).alias("form_n")), "forms")
    # each form is `times` larger than the last, so a chain has a known length; every round doubles what is followed
    most = out.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]
    longest = math.log(max(most, 2)) / math.log(max(times, 1.0001))
    step = written(out.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    for _ in range(math.ceil(math.log2(max(longest, 1)))):
        later = step.select(F.col("word").alias("root"), F.col("root").alias("last"))
        step = written(step.join(later, "root", "left").select("word", F.coalesce("last", "root").alias("root")), "roots")
    return (out.alias("o").join(step.alias("r"), F.col("o.word") == F.col("r.word"), "left")
            .select("o.word", "o.form", F.coalesce("r.root", "o.word").alias("root"), "o.n", "o.n_near", "o.form_n"))


def spelling_variants(docs: DataFrame, **options) -> DataFrame:
    """The words of all texts with their forms."""
    return variants(vocabulary(docs), **options)


SQL = r"""
    WITH RECURSIVE
    crc AS (SELECT list_transform(range(256), lambda i: list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
              lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
    runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
    per_doc AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
    named AS (SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || run)) AS x FROM per_doc),
    coded AS (SELECT run, n, list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)) AS bytes FROM named),
    hashed AS (SELECT run, n, xor(list_reduce(list_concat([4294967295], bytes), lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1])), 4294967295) AS h FROM coded, crc),
    spelt AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
    words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
    cuts AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) AS u(p)),
    pairs AS (
      SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
      UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
    best AS (SELECT word, CAST(count(*) AS BIGINT) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS most FROM pairs GROUP BY word),
    forms AS (SELECT w.word, CASE WHEN most >= 10 * w.n THEN other END AS form, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * w.n THEN most END AS form_n
              FROM words w LEFT JOIN best USING (word)),
    chain AS (SELECT word, word AS root FROM forms UNION ALL SELECT chain.word, form FROM chain JOIN forms ON forms.word = chain.root WHERE form IS NOT NULL)
    SELECT word, form, chain.root, forms.n, n_near, form_n FROM forms JOIN chain USING (word) JOIN forms AS f(w, last, c, d, e) ON f.w = chain.root WHERE f.last IS NULL"""
