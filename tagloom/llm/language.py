"""Language identification by unigram pieces, summed over all segmentations.

A language is a probability for every piece of a fixed public vocabulary. The probability
of a word is the sum, over all ways to cut it into pieces, of the product of the pieces'
probabilities; a forward pass over its bytes makes that sum. A text is as likely as its
words together, and its language is the one it is likeliest in.

Words are runs of letters, lower-cased, with a space before each as the vocabulary has it;
every byte of a character beyond ASCII counts as a letter. A run of over ``WORD_BYTES``
bytes is taken as several words, so that products stay in the range of a double; no
text is cut off. Pieces have up to ``PIECE_BYTES`` bytes: they fit one register.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm import ragged

PIECE_BYTES, WORD_BYTES, SPACE_BYTE = 8, 31, 0x20
# expected counts are whole multiples of 1 / UNIT, so that their sums don't depend on the order
UNIT = 1 << 16
FLOOR = 1e-3
FOLDS, HELD_OUT = 5, 0
CHUNK = 1 << 14
UNKNOWN = "und"
LETTERS = np.zeros(256, bool)
LETTERS[ord("a") : ord("z") + 1] = True
LETTERS[0x80:] = True
_MASKS = [np.uint64((1 << 8 * n) - 1) for n in range(PIECE_BYTES + 1)]
# the highest n bytes of a register
_HIGH = np.array([((1 << 8 * n) - 1) << 8 * (8 - n) for n in range(9)], np.uint64)
_EIGHT = np.uint64(8)


def read_vocabulary(path: str) -> np.ndarray:
    """The pieces of a vocabulary file that can stand in a word, as registers in order.

    The file has a piece a line, base64, and a rank. Single letters are added if they are
    not there, so that every word has a segmentation.
    """
    pieces = {bytes([b]) for b in [SPACE_BYTE, *np.flatnonzero(LETTERS).tolist()]}
    with open(path, "rb") as lines:
        for line in lines:
            piece = base64.b64decode(line.split()[0]) if line.strip() else b""
            letters = piece[piece[:1] == b" " :]
            if letters and len(piece) <= PIECE_BYTES and LETTERS[np.frombuffer(letters, np.uint8)].all():
                pieces.add(piece)
    return np.array(sorted(int.from_bytes(p, "big") for p in pieces), np.uint64)


class Index:
    """From registers to places in the vocabulary; one behind the last for all others."""

    def __init__(self, keys: np.ndarray) -> None:
        self.missing = len(keys)
        bits = max(4, int(len(keys)).bit_length() + 3)
        self.shift = np.uint64(64 - bits)
        self.keys = np.zeros((1 << bits) + 64, np.uint64)
        self.places = np.full(len(self.keys), self.missing, np.int32)
        left, step = np.arange(len(keys)), 0
        while len(left):  # each round puts one key into every free slot that is asked for
            slots = self.slots(keys[left]) + step
            free = self.keys[slots] == 0
            _, one = np.unique(slots[free], return_index=True)
            put = np.flatnonzero(free)[one]
            self.keys[slots[put]] = keys[left[put]]
            self.places[slots[put]] = left[put]
            left = np.delete(left, put)
            step += 1

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(ragged.MULTIPLIER)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slots = self.slots(keys)
        there = self.keys[slots]
        same = there == keys
        out = np.where(same, self.places[slots], self.missing)
        left = np.flatnonzero(~same & (there != 0))
        while len(left):  # a free slot ends the search
            slots[left] += 1
            there = self.keys[slots[left]]
            same = there == keys[left]
            out[left[same]] = self.places[slots[left[same]]]
            left = left[~same & (there != 0)]
        return out


@dataclass
class Words:
    """The different words of some texts: their bytes in four registers, longest first."""

    registers: np.ndarray
    lengths: np.ndarray
    of: np.ndarray  # of each word in the texts, which one it is
    text: np.ndarray  # of each word in the texts, which text it is in


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = np.append(LETTERS[data], False)
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    edge = inside[1:] & (~inside[:-1] | first[1:])
    starts = np.flatnonzero(np.append(inside[:1], edge))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | first[1:])) + 1
    text = np.searchsorted(offsets, starts, "right") - 1
    parts = (ends - starts + WORD_BYTES - 1) // WORD_BYTES
    if len(parts) and parts.max() > 1:
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = np.repeat(starts, parts) + nth * WORD_BYTES
        ends, text = np.minimum(np.repeat(ends, parts), starts + WORD_BYTES), np.repeat(text, parts)
    lengths = ends - starts
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    at = np.ndarray((len(data) + 1,), ">u8", padded.data, 0, (1,))
    registers = np.zeros((4, len(starts)), np.uint64)
    for c in range(4):
        some = np.flatnonzero(lengths > 8 * c) if c else slice(None)
        registers[c, some] = at[starts[some] + 8 * c].astype(np.uint64) & _HIGH[np.minimum(lengths[some] - 8 * c, 8)]
    h = registers[0]
    for c in range(1, 4):
        h = ragged.mixed(h) + registers[c]
    _, pick, of = np.unique(ragged.mixed(h), return_index=True, return_inverse=True)
    # words whose hash another word has got first stand for themselves
    odd = np.flatnonzero((registers != registers[:, pick[of]]).any(axis=0))
    of[odd] = len(pick) + np.arange(len(odd))
    pick = np.concatenate((pick, odd))
    order = np.argsort(-lengths[pick], kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    pick = pick[order]
    return Words(registers[:, pick], lengths[pick], rank[of], text)


def steps(words: Words, a: int, b: int, index: Index) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Byte by byte through the words a to b: the byte's number, how many words have it,
    and for every length of piece which one ends there."""
    lengths, registers = words.lengths[a:b], words.registers[:, a:b]
    held = np.full(b - a, SPACE_BYTE, np.uint64)
    for t in range(int(lengths[0]) + 1):
        m = int(np.searchsorted(-lengths, -t, "right"))
        if t:
            letter = registers[(t - 1) // 8, :m] >> np.uint64(56 - 8 * ((t - 1) % 8))
            held = (held[:m] << _EIGHT) | (letter & _MASKS[1])
        yield t, m, [index.find(held & _MASKS[n]) for n in range(1, min(PIECE_BYTES, t + 1) + 1)]


def likelihoods(words: Words, index: Index, table: np.ndarray) -> np.ndarray:
    """Logarithm of every word's probability in every language: sums over all segmentations."""
    out = np.empty((len(words.lengths), table.shape[1]))
    for a in range(0, len(out), CHUNK):
        b = min(a + CHUNK, len(out))
        alpha = [np.ones((b - a, table.shape[1]))]
        for t, m, found in steps(words, a, b, index):
            now = alpha[-1][:m] * table[found[0]]
            for n in range(1, len(found)):
                hit = np.flatnonzero(found[n] != index.missing)
                now[hit] += alpha[-1 - n][hit] * table[found[n][hit]]
            alpha = [*alpha[-PIECE_BYTES + 1 :], now]
            ended = int(np.searchsorted(-words.lengths[a:b], -t, "left"))
            out[a + ended : a + m] = np.log(now[ended:])
    return out


def expected(words: Words, index: Index, weights: np.ndarray, times: np.ndarray) -> np.ndarray:
    """How often every piece is expected in the words, in units, given each word's count per
    language: a forward and a backward pass under the weights of the pieces."""
    totals = np.zeros((times.shape[1], index.missing + 1))
    for a in range(0, len(words.lengths), CHUNK):
        b = min(a + CHUNK, len(words.lengths))
        seen, alpha = [], [np.ones(b - a)]
        for t, m, found in steps(words, a, b, index):
            now = np.zeros(m)
            for n, piece in enumerate(found, 1):
                now += alpha[t + 1 - n][:m] * weights[piece]
            alpha.append(now)
            seen.append(found)
        lengths = words.lengths[a:b]
        beta = [np.zeros(len(x)) for x in alpha]
        whole = np.empty(b - a)
        used = []
        for t in range(len(seen) - 1, -1, -1):
            m = len(alpha[t + 1])
            ended = int(np.searchsorted(-lengths, -t, "left"))
            beta[t + 1][ended:m] = 1.0
            whole[ended:m] = alpha[t + 1][ended:]
            for n, piece in enumerate(seen[t], 1):
                hit = np.flatnonzero(piece != index.missing)
                passed = weights[piece[hit]] * beta[t + 1][hit]
                beta[t + 1 - n][hit] += passed
                used.append((piece[hit], hit, np.rint(alpha[t + 1 - n][hit] * passed / whole[hit] * UNIT)))
        pieces, of, units = (np.concatenate(x) for x in zip(*used))
        for g in range(times.shape[1]):
            totals[g] += np.bincount(pieces, units * times[a + of, g], len(totals[g]))
    return totals[:, :-1].astype(np.int64)


@dataclass
class Model:
    """Languages in order, log shares of their texts, and a column of probabilities each."""

    keys: np.ndarray
    languages: list[str]
    shares: np.ndarray
    table: np.ndarray

    def score(self, data: np.ndarray, offsets: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
        """The likeliest language of every text, and how likely it is given the text."""
        words = words_of(data, offsets)
        each = likelihoods(words, index, self.table)
        n = len(offsets) - 1
        sums = [np.bincount(words.text, each[words.of, g], n) for g in range(len(self.languages))]
        logs = np.stack(sums, axis=1) + self.shares
        best = logs.argmax(axis=1)
        return best, 1 / np.exp(logs - logs[np.arange(n), best][:, None]).sum(axis=1)


def held_out(id_col: str = "doc_id") -> Column:
    """The fifth of ids that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def _text(text: str) -> Column:
    return F.lower(F.col(text).cast("string")).alias("text")


def fit(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text: str = "text", lang: str = "lang", rounds: int = 1, work_bytes: int = 4 << 20) -> Model | None:
    """Probabilities of the pieces per language, from all texts that are not held out.

    Every round is a pass over the whole corpus: a task adds up how often it expects each
    piece under the weights so far (at first all pieces weigh the same) and hands on one row
    a piece and language; the sums, at most vocabulary times languages, come to the driver.
    ``FLOOR`` of the probability is spread evenly over the vocabulary. None without a text
    to learn from.
    """
    keys = read_vocabulary(vocabulary)
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(id_col))
    rows = known.select(F.col(lang).cast("string").alias("lang"), _text(text))
    model = None
    for _ in range(max(1, rounds)):
        model = _estimated(rows, keys, model, work_bytes)
        if model is None:
            break
    return model


def _estimated(rows: DataFrame, keys: np.ndarray, model: Model | None, work_bytes: int) -> Model | None:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(keys)
        even = np.append(np.full(len(keys), 1 / len(keys)), 0.0)
        sums: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in batches:
            for part in ragged.portions(batch, "text", work_bytes):
                coded = part["lang"].dictionary_encode()
                names, of = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
                words = words_of(*ragged.joined(part["text"]))
                cells = np.bincount(words.of * len(names) + of[words.text], minlength=len(words.lengths) * len(names))
                times = cells.reshape(-1, len(names))
                for g, name in enumerate(names):
                    texts[name] = texts.get(name, 0) + int((of == g).sum())
                if model is None:
                    found = expected(words, index, even, times)
                else:
                    weights = {n: model.table[:, i] for i, n in enumerate(model.languages)}
                    found = np.concatenate(
                        [expected(words, index, weights[n], times[:, g : g + 1]) for g, n in enumerate(names)]
                    )
                for name, row in zip(names, found):
                    sums[name] = sums[name] + row if name in sums else row
        for name, row in sums.items():
            at = np.flatnonzero(row)
            values = [pa.array([name] * (len(at) + 1)), np.append(at, -1).astype(np.int32), np.append(row[at], texts[name])]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=["lang", "piece", "units"])

    added = rows.mapInArrow(run, "lang string, piece int, units long").groupBy("lang", "piece").agg(F.sum("units").alias("units"))
    found = added.toArrow()
    languages = sorted(set(found["lang"].to_pylist()))
    if not languages:
        return None
    place = {n: i for i, n in enumerate(languages)}
    column = np.array([place[n] for n in found["lang"].to_pylist()])
    piece, units = found["piece"].to_numpy(), found["units"].to_numpy()
    texts = np.zeros(len(languages))
    texts[column[piece < 0]] = units[piece < 0]
    table = np.zeros((len(keys) + 1, len(languages)))
    table[piece[piece >= 0], column[piece >= 0]] = units[piece >= 0]
    total = table.sum(axis=0)
    table = np.where(total > 0, (1 - FLOOR) * table / np.maximum(total, 1), (1 - FLOOR) / len(keys)) + FLOOR / len(keys)
    table[-1] = 0
    return Model(keys, languages, np.log(texts / texts.sum()), table)


def identify(
    docs: DataFrame,
    vocabulary: str,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    work_bytes: int = 4 << 20,
    **options,
) -> DataFrame:
    """id_col, held_out, lang_pred and score of every document.

    ``vocabulary`` is a file that the driver can read. The score is the probability of the
    predicted language given the text and the shares of the languages among the learned
    texts; of equally likely languages the one first in order is taken. Null texts and texts
    without a letter are ``und`` with score 0, and so are all texts if there is nothing to
    learn from. Rows without an id are not held out. Repeated rows give repeated rows and
    count as often in what is learned; rows without a language teach nothing. An empty table
    gives no rows; other columns are not read.
    """
    model = fit(docs, vocabulary, id_col=id_col, text=text, lang=lang, work_bytes=work_bytes, **options)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.when(F.col(text).rlike(r"\p{L}"), _text(text)).alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None if model is None else Index(model.keys)
        for batch in batches:
            for part in ragged.portions(batch, "text", work_bytes):
                n = part.num_rows
                read = part["text"].is_valid().to_numpy(zero_copy_only=False)
                names, score = np.full(n, UNKNOWN, object), np.zeros(n)
                if model is not None:
                    best, sure = model.score(*ragged.joined(part["text"]), index)
                    names[read] = np.array(model.languages, object)[best[read]]
                    score[read] = sure[read]
                columns = [part["doc_id"], pa.array(names, pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double").select(
        F.col("doc_id").alias(id_col), held_out("doc_id").alias("held_out"), "lang_pred", "score"
    )
