"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy by backpropagation through time.

A sequence is a run of bytes between ASCII white space, A-Z lower-cased, cut into pieces of ``PIECE`` bytes where longer.
The network reads it in both directions and labels every byte position; a document's probabilities are the mean log
probabilities of all its positions, normalised.  Equal sequences have equal labels, so each worker labels one once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 24
UNKNOWN = "und"
#: Bytes of words with their labels that a task remembers, and of text that it labels at once.
REMEMBERED_BYTES = 32 << 20
BLOCK_BYTES = 4 << 20


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class BiGRU:
    """One layer in each direction; a direction's weights are input rows by byte, recurrent matrix and two biases."""

    def __init__(self, classes: int, hidden: int, seed: int):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.weights = {}
        for d in "fb":
            self.weights[d + "x"] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
            self.weights[d + "h"] = rng.normal(0, hidden ** -0.5, (hidden, 3 * hidden)).astype(np.float32)
            self.weights[d + "c"] = np.zeros(3 * hidden, np.float32)
            self.weights[d + "n"] = np.zeros(hidden, np.float32)
        self.weights["o"] = rng.normal(0, hidden ** -0.5, (2 * hidden, classes)).astype(np.float32)
        self.weights["p"] = np.zeros(classes, np.float32)

    def _read(self, d: str, x: np.ndarray, keep: bool):
        """States after each byte of x (rows are sequences of one length), and what training needs of each step."""
        w, k = self.weights, self.hidden
        h, states, steps = np.zeros((len(x), k), np.float32), [], []
        for t in range(x.shape[1]):
            a, u = w[d + "x"][x[:, t]] + w[d + "c"], h @ w[d + "h"]
            z, r = _sigmoid(a[:, :k] + u[:, :k]), _sigmoid(a[:, k:2 * k] + u[:, k:2 * k])
            m = u[:, 2 * k:] + w[d + "n"]
            n = np.tanh(a[:, 2 * k:] + r * m)
            if keep:
                steps.append((h, z, r, m, n))
            h = n + z * (h - n)
            states.append(h)
        return states, steps

    def log_probs(self, x: np.ndarray) -> np.ndarray:
        """(sequence, position, class) for equally long byte sequences."""
        f, _ = self._read("f", x, False)
        b, _ = self._read("b", x[:, ::-1], False)
        out = np.concatenate([np.stack(f, 1), np.stack(b[::-1], 1)], 2) @ self.weights["o"] + self.weights["p"]
        out -= out.max(2, keepdims=True)
        return out - np.log(np.exp(out).sum(2, keepdims=True))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean cross-entropy over all positions, and its gradients by backpropagation through time."""
        w, k, (rows, length) = self.weights, self.hidden, x.shape
        turned = np.ascontiguousarray(x[:, ::-1])
        fs, f_steps = self._read("f", x, True)
        bs, b_steps = self._read("b", turned, True)
        both = np.concatenate([np.stack(fs, 1), np.stack(bs[::-1], 1)], 2)
        out = both @ w["o"] + w["p"]
        p = np.exp(out - out.max(2, keepdims=True))
        p /= p.sum(2, keepdims=True)
        at = (np.arange(rows)[:, None], np.arange(length)[None], y[:, None])
        loss = float(-np.log(p[at] + 1e-9).mean())
        p[at] -= 1
        p /= rows * length
        g = {"o": np.einsum("rth,rtc->hc", both, p), "p": p.sum((0, 1))}
        d_both = p @ w["o"].T
        for d, xs, steps, dh in (("f", x, f_steps, d_both[:, :, :k]), ("b", turned, b_steps, d_both[:, ::-1, k:])):
            gx, gh = np.zeros_like(w[d + "x"]), np.zeros_like(w[d + "h"])
            gc, gn = np.zeros_like(w[d + "c"]), np.zeros_like(w[d + "n"])
            back = np.zeros((rows, k), np.float32)
            for t in range(length - 1, -1, -1):
                h, z, r, m, n = steps[t]
                e = dh[:, t] + back
                an = e * (1 - z) * (1 - n * n)
                ar = an * m * r * (1 - r)
                az = e * (h - n) * z * (1 - z)
                a, u = np.concatenate([az, ar, an], 1), np.concatenate([az, ar, an * r], 1)
                back = e * z + u @ w[d + "h"].T
                gh += h.T @ u
                gc += a.sum(0)
                gn += (an * r).sum(0)
                np.add.at(gx, xs[:, t], a)
            g |= {d + "x": gx, d + "h": gh, d + "c": gc, d + "n": gn}
        return loss, g


def train(words: list[list[bytes]], hidden: int = 16, steps: int = 400, batch: int = 256, rate: float = 0.01,
          seed: int = 42) -> BiGRU:
    """Fits a network on sequences by class: every step draws one length, and as many sequences of each class that has it.

    Adam; the same input gives the same network.
    """
    rng, model = np.random.default_rng(seed), BiGRU(len(words), hidden, seed)
    by_length: dict[int, dict[int, np.ndarray]] = {}
    for c, ws in enumerate(words):
        for n in sorted({len(w) for w in ws}):
            by_length.setdefault(n, {})[c] = np.frombuffer(b"".join(w for w in ws if len(w) == n), np.uint8).reshape(-1, n)
    lengths = sorted(by_length)
    weight = np.array([n * sum(len(x) for x in by_length[n].values()) for n in lengths], float)
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    for step in range(1, steps + 1):
        have = by_length[lengths[rng.choice(len(lengths), p=weight / weight.sum())]]
        each = max(1, batch // len(have))
        x = np.concatenate([v[rng.integers(len(v), size=each)] for v in have.values()])
        y = np.repeat(list(have), each)
        _, g = model.gradients(x, y)
        now = rate * (0.1 if step > steps * 0.8 else 1)
        for k, v in g.items():
            first[k] = 0.9 * first[k] + 0.1 * v
            second[k] = 0.999 * second[k] + 0.001 * v * v
            model.weights[k] -= (now * (first[k] / (1 - 0.9 ** step)) / (
                np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return model


def pieces(text: str) -> list[bytes]:
    """The sequences of a text."""
    return [w[i:i + PIECE] for w in text.encode().lower().split() for i in range(0, len(w), PIECE)]


class Labeller:
    """Sums of position log probabilities by word, remembered by word."""

    def __init__(self, model: BiGRU, classes: int):
        self.model, self.classes = model, classes
        self.known: dict[str, int] = {}
        self.sums = np.zeros((0, classes), np.float32)
        self.room = REMEMBERED_BYTES

    def words(self, words: list[str]) -> np.ndarray:
        """Row by word: the sum over its positions of their log probabilities."""
        new = [w for w in words if w not in self.known]
        self.room -= sum(map(len, new)) + (200 + 4 * self.classes) * len(new)  # entry, string, sums
        if self.room < 0:
            self.known, self.sums, new = {}, self.sums[:0], words
            self.room = REMEMBERED_BYTES - sum(map(len, new)) - (200 + 4 * self.classes) * len(new)
        if new:
            cut = [pieces(w) for w in new]
            flat = [p for ps in cut for p in ps]
            owner = np.repeat(np.arange(len(new)), [len(ps) for ps in cut])
            size = np.array([len(p) for p in flat], np.int64)
            sums = np.zeros((len(new), self.classes), np.float32)
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                for i in range(0, len(at), 4096):
                    part = at[i:i + 4096]
                    x = np.frombuffer(b"".join(flat[j] for j in part), np.uint8).reshape(-1, n)
                    np.add.at(sums, owner[part], self.model.log_probs(x).sum(1))
            self.known.update(zip(new, range(len(self.sums), len(self.sums) + len(new))))
            self.sums = np.concatenate([self.sums, sums])
        return self.sums[[self.known[w] for w in words]]

    def documents(self, text: pa.Array) -> np.ndarray:
        """Class probabilities of each text, pooled over all its positions."""
        split = pc.ascii_split_whitespace(pc.ascii_lower(text))
        words = pc.dictionary_encode(pc.list_flatten(split))
        names = words.dictionary
        code = words.indices.to_numpy()
        ends = split.offsets.to_numpy()
        ends = ends - ends[0]
        length = pc.binary_length(names).to_numpy()
        total = np.zeros((len(text), self.classes))
        scores = self.words(names.to_pylist())
        for c in range(self.classes):
            total[:, c] = np.diff(np.r_[0, np.cumsum(scores[:, c][code], dtype=np.float64)][ends])
        positions = np.diff(np.r_[0, np.cumsum(length[code], dtype=np.int64)][ends])
        mean = total / np.maximum(positions, 1)[:, None]
        p = np.exp(mean - mean.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def held_out(id_col: Column) -> Column:
    """Whether a document is kept from training: crc32 of its identifier as text leaves 1 modulo 3 (null: empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample_rows: int) -> list:
    """(lang, text) of about ``sample_rows`` labelled rows that aren't held out, twice that at most.

    Chosen by a hash of identifier and text; all of them where there are no more.
    """
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col)))
    n = rows.count()
    if n > sample_rows:
        share = int((1 << 40) * (sample_rows / n))
        rows = rows.filter(F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 40)) < share)
    return rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).limit(
        2 * sample_rows).collect()


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_rows: int = 800, hidden: int = 16, steps: int = 400) -> tuple[BiGRU | None, list[str]]:
    """The network and its classes, learned from a bounded sample of labelled rows (see ``training_rows``)."""
    rows = sorted(training_rows(docs, id_col, text_col, lang_col, sample_rows), key=lambda r: (r["lang"], r["text"]))
    words: dict[str, list[bytes]] = {}
    for r in rows:
        if got := pieces(r["text"]):
            words.setdefault(r["lang"], []).extend(got)
    classes = sorted(words)
    return (train([words[c] for c in classes], hidden, steps) if classes else None), classes


def identify(docs: DataFrame, model: BiGRU | None, classes: list[str], id_col: str = "doc_id", text_col: str = "text",
             extra: tuple = (), with_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, extra columns, and the text as lid_text if asked for.

    ``und`` with score 0 for a null text or one without a letter, and for all where nothing was learned.  Otherwise the
    class of highest pooled probability, the first by name of equal ones, with that probability as score.  Only the
    text decides; every position of the whole text counts.  An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, classes))  # a few ten kilobytes, fixed by its sizes
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), *extra,
                       F.col(text_col).alias("lid_text"))
    kept = [c for c in rows.columns if with_text or c != "lid_text"]

    def run(batches):
        learned, names = shared.value
        labeller = Labeller(learned, len(names)) if names else None
        for batch in batches:
            size = np.cumsum(pc.binary_length(batch["lid_text"].fill_null("")).to_numpy(), dtype=np.int64)
            begin = 0
            while begin < batch.num_rows:
                stop = max(begin + 1, int(np.searchsorted(size, (size[begin - 1] if begin else 0) + BLOCK_BYTES, "right")))
                b = batch.slice(begin, stop - begin)
                begin = stop
                text = b["lid_text"].fill_null("")
                known = pc.match_substring_regex(text, r"\p{L}").to_numpy(zero_copy_only=False) & bool(names)
                best, score = np.zeros(len(text), np.int64), np.zeros(len(text))
                if labeller:
                    p = labeller.documents(text)
                    best, score = p.argmax(1), p.max(1)
                pred = [names[i] if k else UNKNOWN for i, k in zip(best, known)]
                yield pa.RecordBatch.from_arrays([*b.select(kept).columns, pa.array(pred, pa.string()),
                                                  pa.array(np.where(known, score, 0.0))], [*kept, "lang_pred", "score"])
        labeller = None  # what it remembers ends with the task: Spark uses this process for others
        pa.default_memory_pool().release_unused()

    schema = rows.select(kept).schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, schema)
