"""Phrase collocation mining (operator 13), by broadcast double-array tries.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and
pieces into words ``[^\\x20\\x09]+``; everything is counted for each language
(null: ``und``).  Words are counted first; those that occur ``LEAST`` times get
ids, and every text becomes a list of ids in which anything else (a rarer word,
the end of a piece or text) is one break, as no frequent phrase can cross it.

Then level by level: a double-array trie holds the phrases of k-1 words that
can be frequent; numpy advances the states of all positions of a block of ids
at once, a word a step, and counts the accepting states with bincount.  Where a
position and the next one both accept, the k words from there have frequent
beginnings and ends (the Apriori condition): they are proposed, with their
count in the block, and what adds up to ``LEAST`` over all blocks is the
candidate set of the next trie.  Counts of blocks are summed on Spark.  The
counts of the result are those of the accepting states.

A broadcast is bounded: vocabulary and tries go in parts of about ``WORDS``
words and ``PHRASES`` phrases, by hash, and a task holds one part at a time: each
position is looked up in the one part that its words hash to, the positions of
``GROUP`` ids while a part is loaded.  What a task sends leaves in small batches.

Null texts are empty; an empty table, or one without a frequent phrase, gives
no rows; repeated rows count again; other columns are ignored; long texts are
read in segments that end at white space.  Ties are broken by the phrase.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.common import written

LEAST = 30
LONGEST = 4
TOP = 2000
SCALE = 2_000_000
COVER = 80  # per cent of a phrase's occurrences that make a longer one hide it
WORDS = 250_000
PHRASES = 500_000
SEGMENT = 1 << 20
IDS = 1 << 19
GROUP = 1 << 21
DISTINCT = 200_000
KEYS = 1 << 19
SENT = 1 << 16  # keys in a batch that leaves a task
NO_WORD = 0xFFFFFFFF
PRIME, FACTOR = 2**31 - 1, 1_103_515_245  # products stay below 2**63

# fixed values: lower-casing touches A-Z only; these bytes end a piece
PIECE_END = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes(10 if b in PIECE_END else b + 32 if 65 <= b <= 90 else b for b in range(256))
BREAK = b"\xff"  # in no UTF-8 text
SPACE = re.compile(rb"[ \t\n]")


def tokens(text: str | None):
    """Lists of the words of a text as bytes, in order, with ``BREAK`` for the end of a piece."""
    data = (text or "").encode().translate(FOLD)
    at = 0
    while at < len(data):
        m = SPACE.search(data, min(len(data), at + SEGMENT))
        end = m.start() if m else len(data)
        # split() without arguments parts at space and tab here: the other white space ends pieces
        yield data[at:end].replace(b"\n", b" \xff ").split()
        at = end


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.col("text").cast("string").alias("text"))


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n over all texts."""
    def run(batches):
        held, size = {}, 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                own = held.setdefault(lang, Counter())
                before = len(own)
                for part in tokens(text.as_py()):
                    own.update(part)
                size += len(own) - before
                if size > DISTINCT:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    def rows(held):
        for lang, own in held.items():
            own.pop(BREAK, None)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.binary()).cast(pa.string()),
                                              pa.array(own.values(), pa.int64())], names=["lang", "word", "n"])

    return _texts(docs).mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, least: int, words: int) -> tuple[DataFrame, int]:
    """part, id, lang, word, n of the frequent words, and the number of parts.
    Ids are dense in a part, the most frequent words first."""
    frequent = written(counts.where(F.col("n") >= least), "frequent-words")
    parts = max(1, -(-frequent.count() // words))
    own = Window.partitionBy("part").orderBy(F.desc("n"), "lang", "word")
    numbered = frequent.withColumn("part", F.pmod(F.xxhash64("lang", "word"), F.lit(parts)).cast("int")) \
        .withColumn("rank", F.row_number().over(own))
    out = written(numbered.select("part", ((F.col("rank") - 1) * parts + F.col("part")).cast("int").alias("id"), "lang", "word", "n"),
                  "vocabulary")
    return out, parts


def with_part(part, alone: bool, use):
    """``use`` of a broadcast's value.  Unless it is alone, nothing holds the value
    afterwards, so that two parts never meet in memory."""
    try:
        return use(part.value)
    finally:
        if not alone:
            part.__dict__.pop("_value", None)


def word_ids(held: list, known: list) -> np.ndarray:
    """The ids of (lang, words) lists, -1 for words that no part of ``known`` has."""
    sizes = np.array([len(w) for _, w in held])
    names = {lang: i for i, lang in enumerate(dict.fromkeys(lang for lang, _ in held))}
    owner = np.repeat(np.array([names[lang] for lang, _ in held], dtype=np.int32), sizes)
    ids = np.full(len(owner), -1, dtype=np.int32)
    words = {lang: (np.flatnonzero(owner == i), pa.array([x for own, w in held if own == lang for x in w], pa.binary()))
             for lang, i in names.items()}

    def use(table):
        for lang, (spot, own) in words.items():
            if lang in table:
                vocab, number = table[lang]
                at = pc.index_in(own, value_set=vocab).fill_null(-1).to_numpy(zero_copy_only=False)
                hit = at >= 0
                ids[spot[hit]] = number[at[hit]]

    for part in known:
        with_part(part, len(known) == 1, use)
    return ids


def id_blocks(docs: DataFrame, vocab: DataFrame, parts: int) -> DataFrame:
    """ids: the int32 word ids of some texts, -1 for breaks."""
    sc = docs.sparkSession.sparkContext
    known = []
    for p in range(parts):
        table = vocab.where(F.col("part") == p).select("lang", "word", "id").toArrow()
        own = {}
        for lang in table.column("lang").unique().to_pylist():
            t = table.filter(pc.equal(table.column("lang"), lang)).combine_chunks()
            own[lang] = t.column("word").combine_chunks().cast(pa.string()).cast(pa.binary()), t.column("id").to_numpy().astype(np.int32)
        known.append(sc.broadcast(own))

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                for part in tokens(text.as_py()):
                    held.append((lang, part))
                    size += len(part)
                    if size >= IDS:
                        yield block(held)
                        held, size = [], 0
                if held:
                    held[-1][1].append(BREAK)
                    size += 1
        if held:
            yield block(held)

    def block(held):
        ids = word_ids(held, known)
        keep = (ids >= 0) | (np.concatenate([[0], ids[:-1]]) >= 0)
        return pa.RecordBatch.from_arrays([pa.array([ids[keep].tobytes()], pa.binary())], names=["ids"])

    return _texts(docs).mapInArrow(run, "ids binary")


class Trie:
    """A double-array trie of phrases (rows of word ids, equally long).

    The child of state s by symbol c is ``base[s] + c`` if ``check`` of that is
    s; a word is two symbols, from 1, the digits of its rank among the trie's own
    words: no state has more than about the root of their number as children, so
    that families fit between each other."""

    def __init__(self, phrases: np.ndarray):
        self.words = np.unique(phrases)
        self.depth = phrases.shape[1]
        self.digits = max(1, int(np.ceil(np.sqrt(len(self.words)))))
        ranks = np.searchsorted(self.words, phrases)
        order = np.lexsort(ranks.T[::-1])
        ranks = ranks[order]
        n = len(phrases)
        # nodes: at each depth, runs of phrases that agree so far
        new = np.zeros(n, dtype=bool)
        new[:1] = True
        parent_of, symbol_of, total = [], [], 1
        parent = np.zeros(n, dtype=np.int64)
        for d in range(2 * self.depth):
            symbol = (ranks[:, d // 2] % self.digits if d % 2 else ranks[:, d // 2] // self.digits) + 1
            new[1:] |= symbol[1:] != symbol[:-1]
            node = total + np.cumsum(new) - 1
            parent_of.append(parent[new])
            symbol_of.append(symbol[new])
            total += int(new.sum())
            parent = node
        parent_of, symbol_of = np.concatenate(parent_of), np.concatenate(symbol_of)
        slot, self.base, self.check = self.place(parent_of, symbol_of, total, self.digits + 1)
        self.sink = len(self.check) - 1
        self.value = np.full(len(self.check), -1, dtype=np.int32)
        self.value[slot[parent]] = order

    @staticmethod
    def place(parent_of: np.ndarray, symbol_of: np.ndarray, total: int, n_symbols: int):
        """Slots of all nodes, and the arrays: the root's children at their
        symbols, then families of children, the largest first.  Families of like
        size try random bases together; those that meet nothing stay.  Where few
        do, room for the rest of that size is added and they go there."""
        rng = np.random.default_rng(1)
        n_children = np.bincount(parent_of, minlength=total)
        first = np.concatenate([[0], np.cumsum(n_children)])  # children of a node are consecutive and follow its order
        room = n_symbols
        taken = np.zeros(room + n_symbols, dtype=bool)
        slot, at = np.zeros(total, dtype=np.int64), np.zeros(total, dtype=np.int64)
        own = symbol_of[:n_children[0]]
        slot[1:n_children[0] + 1] = own
        taken[own] = taken[0] = True
        families = np.flatnonzero(n_children[1:]) + 1
        families = families[np.argsort(-n_children[families], kind="stable")]
        while len(families):
            size = n_children[families]
            alike = int(np.searchsorted(-size, -(size[0] // 2), side="left"))
            left, families = families[:alike], families[alike:]
            low, tries = 1, 0
            while len(left):
                some = max(1, int(np.searchsorted(np.cumsum(n_children[left]), (room - low) // 2)))
                batch, left = left[:some], left[some:]
                b = rng.integers(low, room, len(batch))
                wide = n_children[batch]
                owner = np.repeat(np.arange(len(batch)), wide)
                child = np.repeat(first[batch], wide) + np.arange(len(owner)) - np.repeat(np.cumsum(wide) - wide, wide)
                target = b[owner] + symbol_of[child]
                free = ~taken[target]
                _, at_first = np.unique(target, return_index=True)
                only = np.zeros(len(target), dtype=bool)
                only[at_first] = True
                good = np.bincount(owner, weights=~(free & only), minlength=len(batch)) == 0
                won = good[owner]
                taken[target[won]] = True
                slot[child[won] + 1] = target[won]
                at[batch[good]] = b[good]
                left = np.concatenate([left, batch[~good]])
                tries = tries + 1 if 16 * int(good.sum()) < len(batch) else 0
                if tries > 4:  # too full for what is left
                    low, tries = room, 0
                    room += 2 * int(n_children[left].sum()) + n_symbols
                    taken = np.concatenate([taken, np.zeros(room + n_symbols - len(taken), dtype=bool)])
        base, check = np.zeros(len(taken) + 1, dtype=np.int32), np.full(len(taken) + 1, -1, dtype=np.int32)
        base[slot] = at
        check[slot[1:]] = slot[parent_of]
        return slot, base, check

    def accepting(self, ids: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """For every position (or those of ``at``) the index of the phrase that starts there, or -1."""
        at = np.arange(len(ids)) if at is None else at
        found = np.full(len(at), -1, dtype=np.int32)
        if not len(self.words):
            return found
        fits = at <= len(ids) - self.depth
        start = at[fits]
        state = np.zeros(len(start), dtype=np.int32)
        for d in range(self.depth):
            word = ids[start + d]
            rank = np.searchsorted(self.words, word)
            rank[rank == len(self.words)] = 0
            state[self.words[rank] != word] = self.sink
            for symbol in (rank // self.digits, rank % self.digits):
                to = self.base[state] + symbol.astype(np.int32) + 1
                state = np.where(self.check[to] == state, to, self.sink).astype(np.int32)
        found[fits] = self.value[state]
        return found


def summed(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their counts.  The lists are emptied."""
    key, n = np.concatenate(keys), np.concatenate(counts)
    keys.clear()
    counts.clear()
    order = np.argsort(key)
    key, n = key[order], n[order]
    del order
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    return key[new], np.add.reduceat(n, new) if len(new) else n


def part_of(ids: np.ndarray, depth: int, parts: int) -> np.ndarray:
    """For every position the part of the trie that can hold the ``depth`` words
    from there, or -1 where a break or the end comes first."""
    n = max(0, len(ids) - depth + 1)
    out = np.full(len(ids), -1, dtype=np.int32)
    h, whole = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    for d in range(depth):
        word = ids[d:d + n]
        whole &= word >= 0
        h = word.astype(np.int64) if depth == 1 else (h + word + 1) * FACTOR % PRIME
    out[:n] = np.where(whole, h % parts, -1)
    return out


def part_column(parts: int):
    """``part_of`` for a column ``words`` of two or more."""
    h = F.aggregate("words", F.lit(0).cast("long"), lambda h, w: (h + w + 1) * FACTOR % PRIME)
    return (h % parts).cast("int")


def block_counts(blocks: list, tries: list, parts: int, k: int, propose: bool):
    """Keys (phrase << 32 | word) and counts of some blocks of ids, in pieces."""
    owner = [part_of(ids, k - 1, parts) for ids in blocks]
    named = [np.full(len(ids) + 1, -1, dtype=np.int64) for ids in blocks]

    def use(p, trie, names):
        n = np.zeros(len(names), dtype=np.int64)
        for ids, own, name in zip(blocks, owner, named):
            at = np.flatnonzero(own == p)
            local = trie.accepting(ids, at)
            hit = local >= 0
            name[at[hit]] = names[local[hit]]
            n += np.bincount(local[hit], minlength=len(names))
        some = np.flatnonzero(n)
        return names[some] << 32 | NO_WORD, n[some]

    for p, part in tries:
        yield with_part(part, len(tries) == 1, lambda value, p=p: use(p, *value))
    if propose:
        for ids, name in zip(blocks, named):
            at = np.flatnonzero((name[:-1] >= 0) & (name[1:] >= 0))
            yield np.unique(name[at] << 32 | ids[at + k - 1], return_counts=True)


def dealt(key: np.ndarray, n: np.ndarray, deals: int):
    """Batches of deal, keys, counts; counts in the narrowest integers that hold a row's."""
    to = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(deals)).astype(np.int32)
    order = np.argsort(to, kind="stable")
    key, n, to = key[order], n[order], to[order]
    del order
    edge = np.concatenate([[0], np.flatnonzero(to[1:] != to[:-1]) + 1, [len(to)]]) if len(to) else np.zeros(1, dtype=np.int64)
    spans = [(i, min(i + SENT, j)) for a, j in zip(edge.tolist(), edge[1:].tolist()) for i in range(a, j, SENT)]
    while spans:
        most = next((x for x in range(1, len(spans)) if spans[x][1] - spans[0][0] > SENT), len(spans))
        now, spans = spans[:most], spans[most:]
        yield pa.RecordBatch.from_arrays([pa.array([int(to[i]) for i, _ in now], pa.int32()),
                                          pa.array([key[i:j].tobytes() for i, j in now], pa.binary()),
                                          pa.array([n[i:j].astype(np.min_scalar_type(n[i:j].max())).tobytes() for i, j in now], pa.binary())],
                                         names=["deal", "keys", "counts"])


def counted(blocks: DataFrame, tries: list, parts: int, k: int, propose: bool, least: int) -> DataFrame:
    """phrase, word, n: with word -1 the occurrences of a trie's phrase; else, if
    at least ``least``, those of the phrase followed by the word where the k-1
    words that end with it are a phrase of the tries as well.

    Counts travel as sorted arrays of keys (phrase << 32 | word) and counts, dealt
    by a hash of the key after each task has summed its own."""
    deals = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), blocks.count() // 2)

    def groups(batches):
        held, size = [], 0
        for batch in batches:
            for raw in batch.column("ids"):
                held.append(np.frombuffer(raw.as_buffer(), dtype=np.int32))
                size += len(held[-1])
                if size >= GROUP:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def run(batches):
        keys, counts, size = [], [], 0
        for held in groups(batches):
            for key, n in block_counts(held, tries, parts, k, propose):
                keys.append(key)
                counts.append(n)
                size += len(key)
                if size > KEYS:
                    key, n = summed(keys, counts)
                    if len(key) > KEYS // 2:
                        yield from dealt(key, n, deals)
                        size = 0
                    else:
                        keys, counts, size = [key], [n], len(key)
        if keys:
            yield from dealt(*summed(keys, counts), deals)

    def total(batches):
        keys, counts, size = [], [], 0
        for batch in batches:
            for key, n in zip(batch.column("keys"), batch.column("counts")):
                keys.append(np.frombuffer(key.as_buffer(), dtype=np.int64))
                counts.append(np.frombuffer(n.as_buffer(), dtype=f"u{8 * len(n.as_buffer()) // len(key.as_buffer())}").astype(np.int64))
                size += len(keys[-1])
                if size > KEYS:
                    key, n = summed(keys, counts)
                    keys, counts, size = [key], [n], 0
        if keys:
            key, n = summed(keys, counts)
            word = key & 0xFFFFFFFF
            keep = (word == NO_WORD) | (n >= least)
            word = np.where(word == NO_WORD, -1, word)[keep]
            yield pa.RecordBatch.from_arrays([pa.array(key[keep] >> 32), pa.array(word, pa.int32()), pa.array(n[keep])], names=["phrase", "word", "n"])

    return blocks.mapInArrow(run, "deal int, keys binary, counts binary").repartition(deals, "deal") \
        .mapInArrow(total, "phrase long, word int, n long")


def numbered(grams: DataFrame, phrases: int) -> tuple[DataFrame, int]:
    """part, id, words with ids that are dense over all parts, and the number of parts."""
    grams = written(grams, "candidates")
    parts = max(1, -(-grams.count() // phrases))
    rank = F.row_number().over(Window.partitionBy("part").orderBy("words")) - 1
    out = grams.withColumn("part", part_column(parts)) \
        .select("part", (rank.cast("long") * parts + F.col("part")).alias("id"), "words")
    return written(out, "numbered-candidates"), parts


def broadcast_tries(grams: DataFrame, parts: int) -> list:
    """(part, broadcast of a trie of its phrases and their ids) of the parts that have some."""
    sc = grams.sparkSession.sparkContext
    out = []
    for p in range(parts):
        table = grams.where(F.col("part") == p).select("id", "words").toArrow().combine_chunks()
        if table.num_rows:
            words = table.column("words").combine_chunks()
            flat = (words.values if isinstance(words, pa.ListArray) else pa.concat_arrays([c.values for c in words.chunks])).to_numpy()
            out.append((p, sc.broadcast((Trie(flat.reshape(table.num_rows, -1)), table.column("id").to_numpy().astype(np.int64)))))
    return out


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, words: int = WORDS,
                  phrases: int = PHRASES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, n of all words), (id, lang, word, n of frequent words) and (words,
    n) of every frequent phrase of up to ``longest`` words."""
    counts = written(word_counts(docs), "word-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    vocab, parts = vocabulary(counts, least, words)
    blocks = written(id_blocks(docs, vocab, parts), "id-blocks")
    grams = vocab.select("part", F.col("id").cast("long").alias("id"), F.array("id").alias("words"))
    found = vocab.select(F.array("id").alias("words"), "n")
    for k in range(2, longest + 2):
        tries = broadcast_tries(grams, parts)
        if not tries:
            break
        both = written(counted(blocks, tries, parts, k, k <= longest, least), f"phrases-{k}")
        for _, t in tries:
            t.unpersist()
        named = both.join(grams.select("id", "words"), F.col("phrase") == F.col("id"))
        if k > 2:
            found = found.unionByName(named.where((F.col("word") < 0) & (F.col("n") >= least)).select("words", "n"))
        if k <= longest:
            grams, parts = numbered(named.where("word >= 0").select(F.concat("words", F.array("word")).alias("words")), phrases)
    return totals, vocab, written(found, "frequent-phrases")


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, words: int = WORDS,
         phrases: int = PHRASES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language."""
    totals, vocab, found = phrase_counts(docs, least, longest, words, phrases)
    long = found.where(F.size("words") > 1).withColumnRenamed("n", "a")
    # the longer phrases that hold a phrase: every proper part of two words or more tells its whole's count
    m = F.size("words")
    inner = long.where(m > 2).select(F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), m - 1), lambda size: F.transform(
            F.sequence(F.lit(1), m - size + 1), lambda at: F.slice("words", at, size))))).alias("words"), "a") \
        .groupBy("words").agg(F.max("a").alias("held"))
    kept = long.join(inner, "words", "left") \
        .where(F.coalesce(F.col("held").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * COVER, F.lit(True)))
    cuts = kept.select("words", "a", F.explode(F.sequence(F.lit(1), m - 1)).alias("k")) \
        .select("words", "a", "k", F.slice("words", F.lit(1), F.col("k")).alias("first"),
                F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("rest"))
    l, r = found.select(F.col("words").alias("first"), F.col("n").alias("l")), found.select(F.col("words").alias("rest"), F.col("n").alias("r"))
    # 2,000,000 * a may pass 64 bits: decimals of 38 digits; the quotient is at most a million
    score = F.expr(f"(cast({SCALE} as decimal(10,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cuts.join(l, "first").join(r, "rest").withColumn("score", score) \
        .groupBy("words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")) \
        .select("words", "a", "cut.l", "cut.r", "cut.score")
    spelled = best.select("words", F.posexplode("words").alias("at", "id")).join(vocab.select("id", "lang", "word"), "id") \
        .groupBy("words").agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w")) \
        .select("words", "lang", F.array_join(F.col("w.word"), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return best.join(spelled, "words").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top) \
        .join(totals, "lang") \
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


ORACLE = r"""
with p as (
  select coalesce(lang, 'und') as lang, row_number() over () as d,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
g as (
  select lang, m, array_to_string(w[i:i + m - 1], ' ') as phrase, w[i:i + m - 1] as ws
  from (select lang, w, m, unnest(range(1, len(w) - m + 2)) as i from w, (select unnest([1, 2, 3, 4]) as m) where len(w) >= m)),
f as (select lang, m, ws, phrase, count(*) as a from g group by all having count(*) >= 30),
total as (select lang, sum(len(w)) as n from w group by 1),
inner_phrases as (
  select lang, ws[i:i + s - 1] as ws, max(a) as held
  from (select lang, ws, m, a, s, unnest(range(1, m - s + 2)) as i from f, (select unnest([2, 3]) as s) where m > s) group by 1, 2),
kept as (
  select f.* from f left join inner_phrases h on h.lang = f.lang and h.ws = f.ws
  where m > 1 and not coalesce(100 * held >= 80 * a, false)),
cuts as (
  select k.lang, k.phrase, k.a, k.ws, k.c, x.a as l, y.a as r,
    (2000000::hugeint * k.a) // (x.a::hugeint + y.a) as score
  from (select *, unnest(range(1, m)) as c from kept) k
  join f x on x.lang = k.lang and x.ws = k.ws[1:k.c]
  join f y on y.lang = k.lang and y.ws = k.ws[k.c + 1:k.m]),
best as (select * from cuts qualify row_number() over (partition by lang, ws order by score, c) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best)
select lang, rank, phrase, a, l, r, n::bigint as n, score::bigint as score from ranked join total using (lang) where rank <= 2000
"""
__all__ = ["Trie", "mine", "phrase_counts", "word_counts"]
