"""Language of a text by a linear-chain conditional random field over its words."""

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from chartspark.llm.common import fold, in_arrow, whole

#: Parts into which keys are dealt, and the one that the model does not learn from.
FOLDS, HELD_OUT = 4, 2
#: Distinct texts of each language that are learnt from, and of all languages together; of each at least ``FEWEST``.
TEXTS_PER_LANGUAGE, TEXTS, FEWEST = 200, 4000, 10
#: Of so many texts of a language in the sample one is for the fit; the others weigh the beginnings of texts.
LEFT_OUT = 2
#: Words of a training sequence, of a stretch of one text in it at most, and taken from a text, spread over all of it.
SEQUENCE, STRETCH, WORDS_PER_TEXT = 64, 24, 144
BUCKET_BITS = 16
EPOCHS, RATE, RIDGE = 4, 0.25, 1e-5
#: Bytes of a word at most. Longer runs of letters, as a whole sentence in scripts without spaces, are words that go on.
WIDTH = 44
#: Words at the beginning of a text that can count more than others, and how much more, of which the best is learnt.
OPENING, WEIGHTS = 8, (0.0, 0.25, 0.5, 1.0, 2.0, 4.0)
#: Words of a piece of a text: forward and backward sums run over all pieces side by side.
PIECE = 128
#: With more labels than this the sums run along each text, since a piece's product grows with their square.
FEW_LABELS = 16
#: Words whose sums are computed at a time, and words remembered by a worker: fewer with many labels.
BATCH_WORDS, KEPT_WORDS = 1 << 18, 1 << 18

# Letters with the marks on them: vowel signs and tone marks are part of a word.
_WORD = regex.compile(r"\p{M}*\p{L}[\p{L}\p{M}]*")
#: Stands where a word goes on from the one before or in the next.
_ON = "\0"


def words_of(text: str) -> list[str]:
    """The words of a text in lower case. Runs of letters of over ``WIDTH`` bytes are cut, and nothing of them is left out."""
    words = _WORD.findall(text.lower())
    if all(4 * len(w) <= WIDTH for w in words):
        return words
    out = []
    for word in words:
        if len(word) * 4 <= WIDTH or len(word.encode("utf-8", "replace")) <= WIDTH:
            out.append(word)
            continue
        step = WIDTH // 4
        parts = [word[i : i + step] for i in range(0, len(word), step)]
        last = len(parts) - 1
        out.extend(f"{_ON * (i > 0)}{part}{_ON * (i < last)}" for i, part in enumerate(parts))
    return out


def features(words: list[str]) -> np.ndarray:
    """Buckets of each word's features, a row each, -1 where there are none.

    Character n-grams of 1 to 4 bytes of the word with a mark on either side; those with a mark are its affixes. Where a
    word goes on there is no mark. The last column is the word itself, its entry in the lexicon.
    """
    coded = [f"{'^' * (w[:1] != _ON)}{w.strip(_ON)}{'$' * (w[-1:] != _ON)}".encode("utf-8", "replace") for w in words]
    lengths = np.array([len(c) for c in coded], np.int64)
    width = max(2, int(lengths.max(initial=0)))
    data = np.zeros((len(coded), width), np.uint32)
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        data[at, :length] = np.frombuffer(b"".join([coded[i] for i in at.tolist()]), np.uint8).reshape(len(at), length)
    columns = []
    for n in (1, 2, 3, 4):
        if n > width:
            break
        code = np.zeros((len(coded), width - n + 1), np.uint64)
        for k in range(n):
            code = code * 257 + data[:, k : width - n + 1 + k]
        on = data[:, n - 1 :] > 0
        columns.append(np.where(on, _bucket(code * 5 + n), -1))
    word = np.zeros(len(coded), np.uint64)
    for k in range(width):
        word = np.where(data[:, k] > 0, word * 1099511628211 + data[:, k], word)
    columns.append(_bucket(word * 5)[:, None])
    return np.concatenate(columns, axis=1)


def _bucket(code: np.ndarray) -> np.ndarray:
    return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


class Field:
    """A linear-chain conditional random field: weights of features by label, and of a label after another."""

    def __init__(self, labels: list[str]):
        self.labels = labels
        n = len(labels)
        self.weights = np.zeros(((1 << BUCKET_BITS) + 1, n), np.float32)  # the last row is for "none"
        self.moves = np.zeros((n, n))
        self.opening_weight = 0.0  # of a text's beginning

    def scores(self, words: list[str]) -> np.ndarray:
        """Each word's scores by label, from its features alone."""
        out = np.empty((len(words), len(self.labels)))
        order = sorted(range(len(words)), key=lambda i: len(words[i]))  # words of like length have like numbers of features
        for i in range(0, len(words), 2048):
            part = order[i : i + 2048]
            out[part] = self._summed(features([words[j] for j in part]))
        return out

    def _summed(self, at: np.ndarray) -> np.ndarray:
        """Sums of the weights of features, a row of ``at`` each."""
        step = max(1, (1 << 24) // (at.shape[1] * len(self.labels)))
        return np.concatenate([self.weights[at[i : i + step]].sum(axis=1) for i in range(0, len(at), step)])

    def fit(self, words: np.ndarray, buckets: np.ndarray, labels: np.ndarray) -> None:
        """Gradient ascent on the sequences' log-likelihood, in batches, with steps scaled by past gradients (AdaGrad).

        ``words`` and ``labels`` are sequences x places; a word is a row of ``buckets``.
        """
        n = len(self.labels)
        past = np.full(self.weights.shape, 1e-2, np.float32)
        past_moves = np.full(self.moves.shape, 1e-2)
        shuffled = np.random.default_rng(0)
        for _ in range(EPOCHS):
            order = shuffled.permutation(len(words))
            for i in range(0, len(order), 32):
                rows = order[i : i + 32]
                at = buckets[words[rows]]
                scores = self._summed(at.reshape(-1, at.shape[-1])).reshape(*at.shape[:2], n)
                marginal, pairs = marginals(scores.astype(float), self.moves)
                truth = np.eye(n)[labels[rows]]
                error = (truth - marginal).reshape(-1, n)
                flat = at.reshape(len(error), -1)
                touched, place = np.unique(flat, return_inverse=True)
                gradient = [np.bincount(place.ravel(), np.repeat(e, flat.shape[1]), len(touched)) for e in error.T]
                g = (np.stack(gradient, axis=1) - RIDGE * self.weights[touched]).astype(np.float32)
                past[touched] += g * g
                self.weights[touched] += RATE * g / np.sqrt(past[touched])
                self.weights[-1] = 0
                seen = np.einsum("sti,stj->ij", truth[:, :-1], truth[:, 1:])
                g = seen - pairs - RIDGE * self.moves
                past_moves += g * g
                self.moves += RATE * g / np.sqrt(past_moves)


def _normal(x):
    return x / x.sum(axis=-1, keepdims=True)


def marginals(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sequences of equal length (sequences x places x labels): P(label at a place), and expected numbers of moves.
    Forward and backward sums, scaled at each place."""
    emit = np.exp(scores - scores.max(axis=-1, keepdims=True))
    move = np.exp(moves)
    forward, backward = np.empty_like(emit), np.empty_like(emit)
    forward[:, 0] = _normal(emit[:, 0])
    for t in range(1, emit.shape[1]):
        forward[:, t] = _normal(forward[:, t - 1] @ move * emit[:, t])
    backward[:, -1] = 1
    for t in range(emit.shape[1] - 2, -1, -1):
        backward[:, t] = _normal((backward[:, t + 1] * emit[:, t + 1]) @ move.T)
    ahead = (emit * backward)[:, 1:]
    total = ((forward[:, :-1] @ move) * ahead).sum(axis=-1, keepdims=True)
    pairs = move * np.einsum("sti,stj->ij", forward[:, :-1] / total, ahead)
    return _normal(forward * backward), pairs


def label_shares(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected share of each label among the words of each text, and among its first ``OPENING`` words (texts x labels
    both), for texts one after another.

    With many labels the sums run along the texts, side by side. Else each text is cut into pieces of ``PIECE`` words. A first run over all pieces side by side gives each piece's product
    of moves and scores; those are passed along the pieces of a text, forwards and backwards; a second run then has the
    exact sums at every word. So the number of steps does not depend on the length of a text.
    """
    n = scores.shape[1]
    if n > FEW_LABELS:
        return _along(scores, lengths, moves)
    counts = -(-lengths // PIECE)
    pieces = int(counts.sum())
    text = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(pieces) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.repeat(np.cumsum(lengths) - lengths, counts) + nth * PIECE
    size = np.minimum(PIECE, np.repeat(lengths, counts) - nth * PIECE)
    emit = np.ones((pieces, PIECE, n))
    on = np.arange(PIECE)[None, :] < size[:, None]
    emit[on] = np.exp(scores - scores.max(axis=1, keepdims=True))
    move, same = np.exp(moves), np.eye(n)
    # what a piece does to the sums before it; places after a text's end change nothing
    product = np.broadcast_to(same, (pieces, n, n)).copy()
    for t in range(PIECE):
        step = product @ move * emit[:, t, None, :]
        product = np.where(on[:, t, None, None], step / step.sum(axis=(1, 2), keepdims=True), product)
    before, after = np.empty((pieces, n)), np.empty((pieces, n))
    first, last = nth == 0, nth == counts[text] - 1
    # a first word has no move before it: start from what the moves take to equal parts
    begin = np.linalg.lstsq(move.T, np.ones(n), rcond=None)[0]
    longest = int(counts.max(initial=0))
    before[first], after[last] = begin, 1.0
    order = np.argsort(nth, kind="stable")
    bounds = np.searchsorted(nth[order], np.arange(longest + 1))
    for k in range(1, longest):
        at = order[bounds[k] : bounds[k + 1]]
        before[at] = _scaled(np.einsum("pi,pij->pj", before[at - 1], product[at - 1]))
    for k in range(longest - 2, -1, -1):
        at = order[bounds[k] : bounds[k + 1]]
        at = at[~last[at]]
        after[at] = _scaled(np.einsum("pij,pj->pi", product[at + 1], after[at + 1]))
    forward = np.empty((pieces, PIECE, n))
    carry = before
    for t in range(PIECE):
        step = carry @ move * emit[:, t]
        carry = np.where(on[:, t, None], _scaled(step), carry)
        forward[:, t] = carry
    shares, opening, carry = np.zeros((pieces, n)), np.zeros((pieces, n)), after
    for t in range(PIECE - 1, -1, -1):
        both = np.maximum(forward[:, t] * carry, 0)
        shares += (here := np.where(on[:, t, None], both / np.maximum(both.sum(axis=1, keepdims=True), 1e-300), 0))
        if t < OPENING:
            opening += here
        carry = np.where(on[:, t, None], _scaled((carry * emit[:, t]) @ move.T), carry)
    out = np.zeros((len(lengths), n))
    np.add.at(out, text, shares)
    first_words = np.minimum(np.minimum(lengths, PIECE), OPENING)
    return out / lengths[:, None], opening[first] / first_words[:, None]


def _along(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`label_shares` word by word: at each step the texts that are long enough."""
    order = np.argsort(-lengths, kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    size = lengths[order]
    alive = len(size) - np.searchsorted(size[::-1], np.arange(size.max(initial=0)), "right")
    emit, move = np.exp(scores - scores.max(axis=1, keepdims=True)), np.exp(moves)
    forward = np.empty_like(emit)
    carry = None
    for t, k in enumerate(alive):
        at = begin[:k] + t
        carry = emit[at] if t == 0 else carry[:k] @ move * emit[at]
        carry = forward[at] = _scaled(carry)
    shares, opening = np.zeros((len(size), scores.shape[1])), np.zeros((len(size), scores.shape[1]))
    carry = np.ones_like(shares)
    for t in range(len(alive) - 1, -1, -1):
        k = alive[t]
        at = begin[:k] + t
        both = forward[at] * carry[:k]
        shares[:k] += (here := both / np.maximum(both.sum(axis=1, keepdims=True), 1e-300))
        if t < OPENING:
            opening[:k] += here
        carry[:k] = _scaled((carry[:k] * emit[at]) @ move.T)
    back = np.argsort(order)
    return (shares / size[:, None])[back], (opening / np.minimum(size, OPENING)[:, None])[back]


def _scaled(x):
    return x / np.abs(x).max(axis=-1, keepdims=True)


def _sequences(texts: list[str], labels: np.ndarray):
    """Words and labels of training sequences: stretches of different texts follow one another, so that there are moves
    from every language to every other."""
    shuffled = np.random.default_rng(0)
    stretches = []
    for text, label in zip(texts, labels):
        words = words_of(text)
        parts = [words[i : i + STRETCH] for i in range(0, len(words), STRETCH)]
        step = max(1, len(parts) * STRETCH // WORDS_PER_TEXT)
        stretches.extend((part, label) for part in parts[::step])
    flat_words, flat_labels = [], []
    for i in shuffled.permutation(len(stretches)):
        flat_words.extend(stretches[i][0])
        flat_labels.extend([stretches[i][1]] * len(stretches[i][0]))
    n = len(flat_words) // SEQUENCE
    if set(flat_labels[n * SEQUENCE :]) - set(flat_labels[: n * SEQUENCE]):  # all the words of a rare language
        repeat = -(-(n + 1) * SEQUENCE // len(flat_words))
        flat_words, flat_labels, n = flat_words * repeat, flat_labels * repeat, n + 1
    return flat_words[: n * SEQUENCE], np.array(flat_labels[: n * SEQUENCE], int).reshape(n, SEQUENCE)


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          texts_per_language: int = TEXTS_PER_LANGUAGE) -> Field | None:
    """A field from a bounded sample of the texts with a language; None if there are none.

    The sample takes the distinct texts of each language with the smallest hashes, all of them if there are few: up to
    ``texts_per_language`` to fit the field to, and as many that the field does not see; copies of a text do not count. With many languages it takes fewer of each, so that they are
    about ``TEXTS`` together, but ``FEWEST`` of each. All languages are learnt.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(lang).cast("string").alias("lang"), whole(F.col(text)).alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & (fold(F.col("key"), FOLDS) != HELD_OUT) & F.col("text").rlike(r"\p{L}"))
    sizes = (
        rows.groupBy("lang")
        .agg(F.approx_count_distinct("text").alias("texts"))
        .orderBy("lang")
        .collect()
    )  # a row for each language
    if not sizes:
        return None
    texts_per_language = LEFT_OUT * min(texts_per_language, max(FEWEST, TEXTS // len(sizes)))
    # twice as many as wanted: the numbers of texts are estimates, and so none comes out short
    shares = {r["lang"]: 2 * texts_per_language / max(1, r["texts"]) for r in sizes}
    limits = [(lang, 2**63 - 1 if share >= 1 else max(1, int(share * 2**64)) - 2**63) for lang, share in shares.items()]
    limits = docs.sparkSession.createDataFrame(limits, "lang string, limit long")
    smallest = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text"))
    # as many rows as the model has labels; no text is shuffled but the chosen ones
    texts = rows.join(F.broadcast(limits), "lang").filter(F.xxhash64("text") <= F.col("limit")).select("lang", "text").distinct()
    texts = texts.withColumn("nth", smallest).filter(F.col("nth") <= texts_per_language).select("lang", "text")

    def spread(batches):
        """A text's words, not all of them if they are many, but from all over the text."""
        for batch in batches:
            out = []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                parts = [words[i : i + STRETCH] for i in range(0, len(words), STRETCH)]
                step = max(1, len(parts) * STRETCH // WORDS_PER_TEXT)
                out.append(_written(w for part in parts[::step] for w in part))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(out, pa.string())], names=["lang", "text"])

    found = in_arrow(texts, spread, "lang string, text string").distinct().toArrow()
    if not found.num_rows:
        return None
    found = found.sort_by([("lang", "ascending"), ("text", "ascending")])
    field = Field(sorted({r["lang"] for r in sizes}))
    index = {label: i for i, label in enumerate(field.labels)}
    samples, truth = found.column("text").to_pylist(), np.array([index[x] for x in found.column("lang").to_pylist()])
    nth = np.arange(len(truth)) - np.searchsorted(truth, truth)  # of its language
    out = nth % LEFT_OUT > 0
    words, labels = _sequences([t for t, x in zip(samples, out, strict=True) if not x], truth[~out])
    if len(labels):
        known = {w: i for i, w in enumerate(dict.fromkeys(words))}
        at = np.array([known[w] for w in words]).reshape(labels.shape)
        field.fit(at, features(list(known)), labels)
        if out.any():
            _weigh_opening(field, [t for t, x in zip(samples, out, strict=True) if x], truth[out])
    return field


def _written(words) -> str:
    """Words as a text with the same words."""
    return " ".join(words).replace(f"{_ON} {_ON}", "")


def _weigh_opening(field: Field, texts: list[str], truth: np.ndarray) -> None:
    """Learn what the beginning of a text counts for, from texts that the field was not fitted to: texts with passages in
    other languages may be labelled by it."""
    words = [words_of(t) for t in texts]
    lengths = np.array([len(w) for w in words])
    known = {w: i for i, w in enumerate(dict.fromkeys(w for text in words for w in text))}
    table = field.scores(list(known))
    shares, openings = label_shares(table[[known[w] for text in words for w in text]], lengths, field.moves)
    right = [((shares + weight * openings).argmax(axis=1) == truth).sum() for weight in WEIGHTS]
    field.opening_weight = WEIGHTS[int(np.argmax(right))]


class Reader:
    """Languages of texts, with the scores of the words met so far."""

    def __init__(self, field: Field):
        self.field = field
        self.known: dict[str, int] = {}
        self.table = np.empty((0, len(field.labels)))
        self.fewer = max(1, len(field.labels) // 8)

    def read(self, texts: list[str]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        held, places, size = [], [], 0
        for i, text in enumerate(texts):
            words = words_of(text)
            if not words:
                continue
            held.append(words)
            places.append(i)
            size += len(words)
            if size >= BATCH_WORDS // self.fewer:
                self._read(held, places, out)
                held, places, size = [], [], 0
        if held:
            self._read(held, places, out)
        return out

    def _read(self, texts, places, out):
        words = [w for text in texts for w in text]
        if len(self.known) > KEPT_WORDS // self.fewer:
            self.known, self.table = {}, self.table[:0]
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            self.table = np.concatenate([self.table, self.field.scores(new)])
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        shares, openings = label_shares(self.table[at], np.array([len(t) for t in texts]), self.field.moves)
        for i, share, opening in zip(places, shares, openings):
            worth = (share + self.field.opening_weight * opening) / (1 + self.field.opening_weight)
            best = int(worth.argmax())
            out[i] = (self.field.labels[best], float(min(1.0, worth[best])))


def language(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", field: Field | None = None) -> DataFrame:
    """key, held_out, lang_pred, score for every row of ``docs``.

    A text's language is the one that most of its words have, by the field's marginals, the first words counting as much
    more as has been learnt; the score is its share of all words so weighed. Words are runs of letters and the marks on
    them; a run of over ``WIDTH`` bytes is several words that go on, of which every character is read. ``und`` with score 0
    stands for a NULL text, a text without letters, and any text if there is nothing to learn from. Equal
    texts have equal results, and no column but the text is looked at. An empty table gives an empty result.
    """
    field = field or train(docs, key, text, lang)
    shared = docs.sparkSession.sparkContext.broadcast(field)  # a bounded number of weights

    def predicted(batches):
        reader = Reader(shared.value) if shared.value is not None else None
        for batch in batches:
            found = reader.read(batch.column("text").to_pylist()) if reader else [("und", 0.0)] * batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                names=["key", "lang_pred", "score"],
            )

    rows = docs.select(F.col(key).alias("key"), whole(F.col(text)).alias("text"))
    schema = rows.drop("text").schema.add("lang_pred", "string").add("score", "double")
    return in_arrow(rows, predicted, schema).select(
        "key", (fold(F.col("key"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score"
    )
