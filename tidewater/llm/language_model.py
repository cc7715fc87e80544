"""A log-bilinear language model, trained with noise-contrastive estimation on every token of the corpus.

The vocabulary grows with the corpus: the words that occur at least as often as
`least_count` says, the end of a text, and one class for all rarer words, which
divides its probability by smoothed counts; so every text gets a normalised
probability.  Two words before predict the next: their vectors, weighted by
position, add up to a prediction.  A word's probability is a product of at most
three choices: among the most frequent words, the end, the rare class and the
branches; among the groups of a branch; among the words of a group.  Each choice
is normalised over all its alternatives by batched matrix products.

All training texts are counted, and the model learns from each of their tokens
once.  A text belongs to one of the rounds; a round's tokens go in packets, dealt
at random, to shards of a bounded number of tokens, as many as there are tokens
for; every shard improves the model on its own, and a vector becomes the mean of
the shards that met it.  When texts are scored, the vocabulary goes to every task; all other
words are looked up by a join.

Words are compared as 64-bit hashes.  A null or empty text is its end alone; rows
without doc_id belong to the training side; repeated rows count each; long texts
are worked on in pieces of PIECE tokens.  Without training texts every word is
unknown and the model is uniform.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.storage import staged
from tidewater.llm.words import LOWER, VISIBLE, Words, bounds, slices, words

WIDTH = 16
HEAD = 32  # most frequent words, each a choice of its own
BRANCHES = 32
GROUP = 64  # least words of a full group
ROUNDS = 3
SHARD = 1_000_000  # tokens of a shard, at least TOKENS_BY_WORD for each word of the vocabulary
TOKENS_BY_WORD = 64
PACKET = 1024  # tokens that follow each other and are dealt together
BATCH = 256  # packets whose tokens take a step together; fewer when a shard has less than STEPS times as many
STEPS = 64
NOISE = 64  # alternatives to a first choice, shared by a batch
DEEP_NOISE = 8  # alternatives to each further choice, shared by a batch's tokens that choose among the same ones
RATE = 0.1
PIECE = 1 << 19
BLOCK = 1024  # rows of the parameters that leave a shard together
HELD = 1_000_000  # distinct counts that a task holds before it gives them away


def least_count(tokens: int) -> int:
    """Occurrences that bring a word into the vocabulary: 2 up to four million tokens, then with the power 3/4 of the tokens.

    At most tokens / least_count words pass; by Zipf's law they grow with the fourth
    root of the tokens: about a million words (130 MB) for a terabyte of text.
    """
    return max(2, int(2 * (tokens / 4_000_000) ** 0.75))


def held_out(doc_id: str) -> Column:
    """Documents that are not trained on: crc32 of the id as text leaves 1 when divided by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 1, F.lit(False))


class Counter:
    """Counts of 64-bit values, merged now and then."""

    def __init__(self) -> None:
        self.values, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, values: np.ndarray) -> None:
        own = np.unique(values, return_counts=True)
        self.waiting.append(own)
        self.size += len(own[0])
        if self.size > HELD:
            self.merge()

    def merge(self) -> None:
        values = np.concatenate([self.values, *[v for v, _ in self.waiting]])
        times = np.concatenate([self.times, *[t for _, t in self.waiting]])
        self.values, back = np.unique(values, return_inverse=True)
        self.times = np.bincount(back, weights=times, minlength=len(self.values)).astype(np.int64)
        self.waiting, self.size = [], 0

    def taken(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        self.merge()
        if len(self.values) > least:
            yield from pa.table([pa.array(self.values), pa.array(self.times)], ["value", "n"]).to_batches(max_chunksize=50_000)
            self.values, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)


def _counted(texts: DataFrame, values_of) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counter()
        for batch in slices(batches, "text"):
            held.add(values_of(words(batch.column("text"), VISIBLE, LOWER), batch.num_rows))
            if len(held.values) > HELD:
                yield from held.taken(HELD)
        yield from held.taken(-1)

    return texts.mapInArrow(count, "value bigint, n bigint").groupBy("value").agg(F.sum("n").alias("n"))


def word_counts(texts: DataFrame) -> DataFrame:
    """`word, n` over all texts."""
    return _counted(texts, lambda w, rows: w.hash.view(np.int64)).withColumnRenamed("value", "word")


@dataclass
class Classes:
    """Sorted word hashes and their classes 1, 2, ...; 0 is any other word, then come the end and the place before a text."""

    words: np.ndarray
    number: np.ndarray

    @property
    def size(self) -> int:
        return len(self.words) + 3

    @property
    def end(self) -> int:
        return len(self.words) + 1

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.number[at], 0)


def sequences(w: Words, rows: int, classes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, class, class before and class before that, of all words and ends; `classes` are those of the words."""
    sizes = np.diff(bounds(w.doc, rows)) + 1
    doc = np.repeat(np.arange(rows), sizes)
    token = np.full(len(doc), end, np.int64)
    token[np.arange(len(w.doc)) + w.doc] = classes
    place = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    before = [np.where(place >= k, np.concatenate([np.zeros(k, np.int64), token[:-k]])[: len(token)], end + 1) for k in (1, 2)]
    return doc, token, before[0], before[1]


def keyed(texts: DataFrame) -> DataFrame:
    """`text, key`: the key tells a text's round and is different for equal texts."""
    return texts.select("text", F.xxhash64(F.monotonically_increasing_id(), "text").bitwiseAND((1 << 31) - 1).alias("key"))


def short(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Numbers from 0 on in as few bytes as they need, seven bits each, the last one below 128; where each number begins, and the end."""
    sizes = [np.flatnonzero(values >= 1 << 7 * k) for k in range(1, 5)]
    size = np.ones(len(values), np.int64)
    for longer in sizes:
        size[longer] += 1
    start = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(start[-1], np.uint8)
    out[start[:-1]] = values & 127
    for k, longer in enumerate(sizes):
        out[start[longer] + k] |= 128
        out[start[longer] + k + 1] = values[longer] >> 7 * (k + 1) & 127
    return out.tobytes(), start


def long(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that `short` wrote, and where the last byte of each is."""
    last = np.flatnonzero(data < 128)
    start = np.concatenate([[0], last + 1])[:-1]
    size, values = last - start, (data[start] & 127).astype(np.int64)
    for k in range(1, 5):
        longer = np.flatnonzero(size >= k)
        values[longer] |= (data[start[longer] + k] & 127).astype(np.int64) << 7 * k
    return values, last


def packets(texts: DataFrame, classes: Classes, rounds: int = ROUNDS) -> DataFrame:
    """`tokens, key` from `text, key`: the classes of all tokens in packets, each behind the two classes before it.

    The key is random, but leaves what the texts' keys leave when divided by `rounds`.
    """
    sent = texts.sparkSession.sparkContext.broadcast(classes)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([11, TaskContext.get().partitionId()])
        known = sent.value
        for batch in slices(batches, "text"):
            w = words(batch.column("text"), VISIBLE, LOWER)
            doc, token, one, two = sequences(w, batch.num_rows, known.of(w.hash), known.end)
            at = np.arange(0, len(token), PACKET)
            (front, upto), (rest, begin) = short(np.stack([two[at], one[at]], axis=1).ravel()), short(token)
            upto, begin = upto[::2].tolist(), [*begin[at].tolist(), len(rest)]
            own = [front[upto[i] : upto[i + 1]] + rest[begin[i] : begin[i + 1]] for i in range(len(at))]
            key = batch.column("key").to_numpy()[doc[at]] + rounds * rng.integers(0, 1 << 31, len(at))
            yield pa.record_batch([pa.array(own, pa.binary()), pa.array(key)], ["tokens", "key"])

    return texts.mapInArrow(pack, "tokens binary, key bigint")


def unpacked(tokens: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, class before and class before that, of all tokens in packets."""
    held, last = long(np.frombuffer(b"".join(tokens), np.uint8))
    firsts = np.searchsorted(last, np.cumsum([0, *map(len, tokens)])[:-1])
    inside = np.ones(len(held), bool)
    inside[firsts] = inside[firsts + 1] = False
    at = np.flatnonzero(inside)
    w, one, two = held[at], held[at - 1], held[at - 2]
    two = np.where((one == end) | (two == end), end + 1, two)
    return w, np.where(one == end, end + 1, one), two


class Tree:
    """The choices that lead to a class, numbered: first choice, groups of branches, words of groups.

    The first choice has the rare class (0), the head words, the end and the branches.
    """

    def __init__(self, vocabulary: int) -> None:
        self.head = min(vocabulary, HEAD)
        self.end = vocabulary + 1
        self.tail = vocabulary - self.head
        self.group = max(GROUP, int(np.ceil(np.sqrt(self.tail / BRANCHES))))
        self.groups = -(-self.tail // self.group)
        self.branch = max(1, -(-self.groups // BRANCHES))
        self.first = self.head + 2 + -(-self.groups // self.branch)
        self.size = self.first + self.groups + self.tail

    def sums(self, n: np.ndarray) -> np.ndarray:
        """Weights of all choices from the weights of the classes 0 to end."""
        tail = n[self.head + 1 : self.end]
        groups = np.add.reduceat(tail, np.arange(0, self.tail, self.group)) if self.tail else tail
        branches = np.add.reduceat(groups, np.arange(0, self.groups, self.branch)) if self.tail else tail
        return np.concatenate([n[: self.head + 1], n[self.end : self.end + 1], branches, groups, tail])

    def borders(self) -> tuple[np.ndarray, np.ndarray]:
        """First choice and one past the last of the alternatives of every choice."""
        start, end = np.zeros(self.size, np.int64), np.full(self.size, self.first)
        group, word = np.arange(self.groups), np.arange(self.tail)
        start[self.first :] = self.first + np.concatenate([group // self.branch * self.branch, self.groups + word // self.group * self.group])
        end[self.first :] = np.minimum(start[self.first :] + np.repeat([self.branch, self.group], [self.groups, self.tail]), np.repeat([self.first + self.groups, self.size], [self.groups, self.tail]))
        return start, end

    def path(self, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First choice of every class; the classes that lie deeper (their indices), their groups and words."""
        deep = np.flatnonzero((token > self.head) & (token < self.end))
        word = token[deep] - self.head - 1
        group = word // self.group
        top = np.where(token == self.end, self.head + 1, token)
        top[deep] = self.head + 2 + group // self.branch
        return top, deep, self.first + group, self.first + self.groups + word


@dataclass
class Model:
    classes: Classes
    context: np.ndarray  # vectors of classes before
    target: np.ndarray  # vectors of choices
    bias: np.ndarray
    weight: np.ndarray  # two rows: by position

    def predictions(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.context[one] * self.weight[0] + self.context[two] * self.weight[1]

    def _chosen(self, r: np.ndarray, choice: np.ndarray, start: int, end: int) -> np.ndarray:
        scores = r @ self.target[start:end].T
        scores += self.bias[start:end]
        if max(scores.max(), -scores.min()) > 60:  # else no exponential leaves the range of 32 bits
            scores -= scores.max(axis=1, keepdims=True)
        own = scores[np.arange(len(r)), choice - start]
        np.exp(scores, out=scores)
        return own - np.log(scores @ np.ones(end - start, scores.dtype))

    def logs(self, token: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Natural logarithms of the probabilities of classes after the two before them."""
        tree, out = Tree(len(self.classes.words)), np.empty(len(token))
        for at in range(0, len(token), PIECE):
            part = slice(at, at + PIECE)
            r = self.predictions(one[part], two[part])
            top, deep, group, word = tree.path(token[part])
            found = np.concatenate([self._chosen(r[k : k + 4096], top[k : k + 4096], 0, tree.first) for k in range(0, len(r), 4096)]).astype(float)
            if len(deep):
                order = np.argsort(group, kind="stable")
                rs, group, word = r[deep[order]], group[order], word[order]
                for choice, low, most, width in ((group, tree.first, tree.first + tree.groups, tree.branch), (word, tree.first + tree.groups, tree.size, tree.group)):
                    kin = (choice - low) // width
                    cuts = np.flatnonzero(np.concatenate([[True], kin[1:] != kin[:-1], [True]]))
                    log = np.empty(len(choice))
                    for a, b in zip(cuts[:-1], cuts[1:]):
                        start = low + int(kin[a]) * width
                        log[a:b] = self._chosen(rs[a:b], choice[a:b], start, min(start + width, most))
                    found[deep[order]] += log
            out[part] = found
        return out

    def rows(self) -> np.ndarray:
        """All parameters, a row for each vector: contexts, choices with their bias, positions."""
        n = len(self.context)
        out = np.zeros((n + len(self.target) + 2, self.context.shape[1] + 1), np.float32)
        out[:n, :-1], out[n:-2, :-1], out[n:-2, -1], out[-2:, :-1] = self.context, self.target, self.bias, self.weight
        return out

    def of_rows(self, rows: np.ndarray) -> Model:
        n = len(self.context)
        return Model(self.classes, *(np.ascontiguousarray(a) for a in (rows[:n, :-1], rows[n:-2, :-1], rows[n:-2, -1], rows[-2:, :-1])))


def first_model(classes: Classes, unigram: np.ndarray, width: int = WIDTH) -> Model:
    """The unigram model: all choices have the logarithms of their shares as bias and vectors of zeros."""
    rng = np.random.default_rng(7)
    tree = Tree(len(classes.words))
    mass = tree.sums(unigram)
    start, end = tree.borders()
    upto = np.concatenate([[0], np.cumsum(mass)])
    bias = np.log(mass / (upto[end] - upto[start]))
    context = rng.standard_normal((classes.size, width), np.float32) * np.float32(0.3)
    return Model(classes, context, np.zeros((tree.size, width), np.float32), bias.astype(np.float32), np.ones((2, width), np.float32))


def improve(model: Model, draws: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]], unigram: np.ndarray, seed: int, rate: float = RATE) -> tuple[Model, np.ndarray]:
    """A noise-contrastive step for each batch of tokens (class, class before and class before that), and which rows of the parameters they met.

    The noise of a choice are alternatives by their shares, drawn once in a batch for all tokens
    that choose among the same ones; steps shrink by the squares of a row's slopes.
    """
    rng = np.random.default_rng(seed)
    tree = Tree(len(model.classes.words))
    upto = np.concatenate([[0], np.cumsum(tree.sums(unigram))])
    start, end = tree.borders()
    share = np.log(np.diff(upto) / (upto[end] - upto[start])).astype(np.float32)
    context, target, bias, weight = (a.copy() for a in (model.context, model.target, model.bias, model.weight))
    least = np.float32(1e-1)
    squares = [np.full(len(a), least) for a in (context, target, bias, weight)]

    def step(k: int, array: np.ndarray, rows: np.ndarray, total: np.ndarray) -> None:
        squares[k][rows] += np.einsum("nw,nw->n", total, total) / np.float32(total.shape[1]) if total.ndim > 1 else total * total
        by = np.float32(rate) / np.sqrt(squares[k][rows])
        array[rows] += total * (by[:, None] if total.ndim > 1 else by)

    def chance(scores: np.ndarray) -> np.ndarray:
        np.clip(scores, -30, 30, out=scores)
        np.negative(scores, out=scores)
        np.exp(scores, out=scores)
        scores += 1
        return np.reciprocal(scores, out=scores)

    def runs(in_order: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.concatenate([[True], in_order[1:] != in_order[:-1]]))

    def summed(at: np.ndarray, *slopes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct rows and the sums of their slopes."""
        order = np.argsort(at)
        firsts = runs(at[order])
        return at[order[firsts]], *(np.add.reduceat(x[order], firsts, axis=0) for x in slopes)

    def learn(choice: np.ndarray, r: np.ndarray, many: int) -> np.ndarray:
        """Improve the choices, which are in order; slopes of the predictions."""
        log_many = np.float32(np.log(many))
        own = target[choice]
        up = 1 - chance(np.einsum("nw,nw->n", own, r) + bias[choice] - share[choice] - log_many)
        back = up[:, None] * own
        same = runs(choice)
        rows, slopes, errors = [choice[same]], [np.add.reduceat(up[:, None] * r, same, axis=0)], [np.add.reduceat(up, same)]
        kin = start[choice]
        firsts = runs(kin)
        begin, upper = kin[firsts], end[choice[firsts]]
        low, high = upto[begin], upto[upper]
        noise = np.searchsorted(upto, low[:, None] + rng.random((len(firsts), many)) * (high - low)[:, None], "right") - 1
        noise = np.clip(noise, begin[:, None], upper[:, None] - 1)
        vectors, shift = target[noise], (bias - share)[noise] - log_many
        ones = np.ones(PIECE, np.float32)
        for k, (x, y) in enumerate(zip(firsts.tolist(), [*firsts[1:].tolist(), len(choice)])):
            for at in range(x, y, 8192):
                part = slice(at, min(at + 8192, y))
                down = r[part] @ vectors[k].T
                down += shift[k]
                chance(down)
                back[part] -= down @ vectors[k]
                rows.append(noise[k])
                slopes.append(-(down.T @ r[part]))
                errors.append(-(ones[: len(down)] @ down))
        met, total, error = summed(np.concatenate(rows), np.concatenate(slopes), np.concatenate(errors))
        step(1, target, met, total)
        step(2, bias, met, error)
        return back

    for w, one, two in draws:
        order = np.argsort(w)
        w, one, two = w[order], one[order], two[order]
        top, deep, group, word = tree.path(w)
        first, second = context[one], context[two]
        guess = first * weight[0] + second * weight[1]
        by_top = np.argsort(top, kind="stable")
        back = np.empty_like(guess)
        back[by_top] = learn(top[by_top], guess[by_top], NOISE)
        if len(deep):
            r = guess[deep]
            back[deep] += learn(group, r, DEEP_NOISE) + learn(word, r, DEEP_NOISE)
        met, total = summed(np.concatenate([one, two]), np.concatenate([back * weight[0], back * weight[1]]))
        step(0, context, met, total)
        step(3, weight, np.arange(2), np.stack([np.einsum("nw,nw->w", back, first), np.einsum("nw,nw->w", back, second)]))
    moved = np.concatenate([s > least for s in (squares[0], np.maximum(squares[1], squares[2]), squares[3])])
    return Model(model.classes, context, target, bias, weight), moved


def shards_of(drawn: int, vocabulary: int) -> int:
    """Parts of a round's tokens, each enough for the vectors it sends back."""
    return max(1, -(-drawn // max(SHARD, TOKENS_BY_WORD * vocabulary)))


def dealt(drawn: DataFrame, turn: int, rounds: int, shards: int) -> DataFrame:
    """The rows of a round, spread evenly by their keys; no more shards than asked for, however many partitions they were dealt to.

    Each shard sends its vectors back, so what a round shuffles grows with their number.
    """
    return drawn.where(F.col("key") % rounds == turn).repartition(shards, F.xxhash64("key")).coalesce(shards)


def in_blocks(at: np.ndarray, rows: np.ndarray) -> pa.Table:
    """`block, met, vectors`: the rows numbered `at`, which are in order, BLOCK places to a row of bytes."""
    first = np.arange(at[0] // BLOCK, at[-1] // BLOCK + 1) if len(at) else np.zeros(0, np.int64)
    cuts = np.searchsorted(at, np.append(first, first[-1:] + 1) * BLOCK)
    own = [(b, (at[x:y] - b * BLOCK).astype("<u2").tobytes(), rows[x:y].astype("<f4").tobytes()) for b, x, y in zip(first.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()) if y > x]
    return pa.table([pa.array([o[k] for o in own], kind) for k, kind in enumerate((pa.int64(), pa.binary(), pa.binary()))], ["block", "met", "vectors"])


def of_blocks(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers and rows that `in_blocks` took, block after block."""
    at = [b * BLOCK + np.frombuffer(m, "<u2").astype(np.int64) for b, m in zip(table.column("block").to_pylist(), table.column("met").to_pylist())]
    rows = [np.frombuffer(v, "<f4").reshape(-1, width) for v in table.column("vectors").to_pylist()]
    return np.concatenate([np.zeros(0, np.int64), *at]), np.concatenate([np.zeros((0, width), np.float32), *rows])


def means(parts: DataFrame, width: int) -> DataFrame:
    """`block, met, vectors`: the mean of each row over the shards that sent it."""

    def mean(table: pa.Table) -> pa.Table:
        at, rows = of_blocks(table, width)
        own, back, times = np.unique(at, return_inverse=True, return_counts=True)
        total = np.zeros((len(own), width))
        np.add.at(total, back, rows)
        return in_blocks(own, total / times[:, None])

    return parts.groupBy("block").applyInArrow(mean, parts.schema)


def trained(texts: DataFrame, tokens: int, model: Model, unigram: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Rounds of improvement in all shards, each text in one of them; a row of the parameters becomes the mean of the shards that met it.

    `tokens` is the number of all tokens, ends included.  Only the rows that a shard met leave it, in blocks of bytes, which take half of what
    columns of sums and counts do; the driver gets one mean for each, in all the size of the model.
    """
    sc, classes = texts.sparkSession.sparkContext, model.classes
    shards = shards_of(tokens // rounds, len(classes.words))
    texts = keyed(texts)
    width = model.context.shape[1] + 1
    for turn in range(rounds):
        sent = sc.broadcast((model, unigram))

        def work(batches: Iterator[pa.RecordBatch], turn: int = turn, sent=sent) -> Iterator[pa.RecordBatch]:
            held = [b for b in batches if b.num_rows]
            if not held:
                return
            own = pa.Table.from_batches(held).sort_by([("key", "ascending"), ("tokens", "ascending")]).column("tokens")
            start, masses = sent.value
            size = max(1, min(BATCH, len(own) // STEPS))
            batches_ = (unpacked(own[k : k + size].to_pylist(), start.classes.end) for k in range(0, len(own), size))
            done, met = improve(start, batches_, masses, seed=1_000_003 * turn + TaskContext.get().partitionId())
            at = np.flatnonzero(met)
            yield from in_blocks(at, done.rows()[at]).to_batches(max_chunksize=50)

        drawn = packets(texts.where(F.col("key") % rounds == turn), classes, rounds)
        parts = dealt(drawn, turn, rounds, shards).mapInArrow(work, "block bigint, met binary, vectors binary")
        at, new = of_blocks(means(parts, width).toArrow(), width)
        rows = model.rows()
        rows[at] = new
        sent.destroy()
        del at, new, sent
        model = model.of_rows(rows)
    return model


@dataclass
class Totals:
    tokens: int  # of the training texts, ends included
    distinct: int
    other_tokens: int  # of words outside the classes
    other_distinct: int


@dataclass
class Trained:
    model: Model
    totals: Totals
    counts: DataFrame  # word, n
    times: np.ndarray  # of the words of the model's classes


def fit(docs: DataFrame, text: str = "text", rounds: int = ROUNDS) -> Trained:
    """Count and train on all rows of `docs`."""
    texts = docs.select(F.col(text).alias("text"))
    ends = docs.select(F.lit(1).alias("one")).count()
    counts = staged(word_counts(texts), "words")
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = counts.where(F.col("n") >= least_count(sums["n"])).toArrow()  # the size of the model
    hashes, times = top.column("word").to_numpy().view(np.uint64), top.column("n").to_numpy()
    rank = np.lexsort((hashes, -times))
    order = np.argsort(hashes[rank])
    classes = Classes(hashes[rank][order], order + 1)
    inside = int(times.sum())
    unigram = np.concatenate([[sums["n"] - inside], times[rank], [ends]]) + 0.5
    model = trained(texts, sums["n"] + ends, first_model(classes, unigram), unigram, rounds)
    totals = Totals(sums["n"] + ends, sums["v"] + (ends > 0), sums["n"] - inside, sums["v"] - len(classes.words))
    return Trained(model, totals, counts, times[rank][order])


_PARTS = "row bigint, n_tokens bigint, n_known bigint, base double, score double, rest array<struct<word:bigint,n:bigint>>"


def scored(docs: DataFrame, lm: Trained, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, n_tokens, n_known, train_tokens, base_score, score` of every row, as log10 probabilities.

    `base_score` is the smoothed unigram model, `score` the log-bilinear one.
    """
    t = lm.totals
    classes = lm.model.classes
    shared = docs.sparkSession.sparkContext.broadcast((lm.model, np.log10(lm.times + 0.5)))
    base_norm = np.log10(t.tokens + 0.5 * (t.distinct + 1))
    other_norm = np.log10(t.other_tokens + 0.5 * (t.other_distinct + 1))
    end_known = t.distinct > 0
    end_n = int(t.tokens - t.other_tokens - lm.times.sum())
    end_log = np.log10(end_n + 0.5)
    kind = dict(docs.dtypes)[doc_id]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        model, inside_log = shared.value
        known, number = model.classes.words, model.classes.number
        for batch in slices(batches, "text"):
            rows = batch.num_rows
            w = words(batch.column("text"), VISIBLE, LOWER)
            at = np.minimum(np.searchsorted(known, w.hash), max(0, len(known) - 1))
            near = known[at] == w.hash if len(known) else np.zeros(len(at), bool)
            add = lambda values, doc: np.bincount(doc, weights=values, minlength=rows)
            log = np.where(near, inside_log[at], 0.0) if len(known) else np.zeros(len(at))
            n_tokens = np.bincount(w.doc, minlength=rows) + 1
            of_words = np.where(near, number[at], 0) if len(known) else np.zeros(len(at), np.int64)
            doc, token, before, earlier = sequences(w, rows, of_words, model.classes.end)
            logs = model.logs(token, before, earlier) / np.log(10)
            other = ~near
            far = np.flatnonzero(~near)
            order = far[np.lexsort((w.hash[far], w.doc[far]))]
            h, d = w.hash[order], w.doc[order]
            first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])) if len(h) else np.zeros(0, np.int64)
            times = np.diff(np.append(first, len(h)))
            ends = np.searchsorted(d[first], np.arange(rows + 1)).astype(np.int32)
            rest = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(h[first].view(np.int64)), pa.array(times.astype(np.int64))], ["word", "n"]))
            out = [
                batch.column("doc_id"),
                pa.array(row + np.arange(rows, dtype=np.int64)),
                pa.array(n_tokens.astype(np.int64)),
                pa.array(add(near, w.doc).astype(np.int64) + int(end_known)),
                pa.array(add(log, w.doc) + end_log - n_tokens * base_norm),
                pa.array(add(logs, doc) - add(other, w.doc) * other_norm),
                rest,
            ]
            row += rows
            yield pa.record_batch(out, ["doc_id", "row", "n_tokens", "n_known", "base", "score", "rest"])

    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    parts = staged(named.mapInArrow(score, f"doc_id {kind}, {_PARTS}"), "scores")
    far = parts.select("row", F.explode("rest").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
    met = far.join(lm.counts, "word", "left")
    sums = met.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("log"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("known"),
    )
    log = F.coalesce("log", F.lit(0.0))
    return parts.join(sums, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(int(t.tokens)).cast("bigint").alias("train_tokens"),
        (F.col("base") + log).alias("base_score"),
        (F.col("score") + log).alias("score"),
    )
