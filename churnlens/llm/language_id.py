"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads segments of a text's UTF-8 bytes in both directions and labels every
byte; the labels' mean over the whole text is its language. It is trained here, by
backpropagation through time, on a sample of labelled rows whose size is a parameter,
and is small enough to be sent to every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.tables import map_batches, small_batches
from churnlens.operators.materialise import materialise

SEGMENT = 64
HIDDEN = 8
MAX_ROWS = 64 * 256  # rows that are learnt from, if there are no more languages
NOISE = "noise"
NOISE_SHARE = 0.7  # of a text's bytes; clean documents of the test tables reach 0.16
_ROWS = 2048  # segments that are worked on at once, with up to 64 languages


# The network ------------------------------------------------------------------


def cut_segments(texts: list[bytes], segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of all texts in rows of ``segment``: bytes, valid bytes of each row, and
    the row each text starts at."""
    counts = np.array([-(-len(t) // segment) for t in texts], int)
    starts = np.concatenate([[0], np.cumsum(counts)])
    padded = b"".join(t.ljust(n * segment, b"\0") for t, n in zip(texts, counts))
    sizes = np.full(starts[-1], segment)
    for text, start, count in zip(texts, starts, counts):
        if count:
            sizes[start + count - 1] = len(text) - (count - 1) * segment
    return np.frombuffer(padded, np.uint8).reshape(-1, segment), sizes, starts[:-1]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


class Network:
    """Two gated recurrent layers, one for each direction, and a softmax at every byte."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.languages, self.hidden = languages, hidden
        self.known = np.zeros(256, bool)  # bytes of the labelled texts it was fitted on
        self.weights = {"out": draw(2 * hidden, len(languages), scale=0.3), "bias": np.zeros(len(languages), np.float32)}
        for way in ("ahead", "back"):
            # Gates in the order update, reset, candidate; the input weights hold the biases.
            self.weights[f"{way}_in"] = draw(256, 3 * hidden, scale=0.5)
            self.weights[f"{way}_state"] = draw(hidden, 3 * hidden, scale=hidden**-0.5)

    def _run(self, way: str, steps: list[int], data: np.ndarray, valid: np.ndarray, keep: list | None) -> np.ndarray:
        """States (segment, rows, hidden) of one direction; padding has state zero."""
        h, inner, outer = self.hidden, self.weights[f"{way}_state"], self.weights[f"{way}_in"]
        states = np.zeros((data.shape[1], len(data), h), np.float32)
        state = np.zeros((len(data), h), np.float32)
        for t in steps:
            given, carried = outer[data[:, t]], state @ inner
            gates = _sigmoid(given[:, : 2 * h] + carried[:, : 2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            new = np.tanh(given[:, 2 * h :] + reset * carried[:, 2 * h :])
            before, state = state, new + update * (state - new)
            if not valid[:, t].all():
                state = state * valid[:, t, None]
            states[t] = state
            if keep is not None:
                keep.append((t, before, update, reset, new, carried[:, 2 * h :]))
        return states

    def labels(self, data: np.ndarray, valid: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Probabilities (segment, rows, languages) of every byte."""
        size, h = data.shape[1], self.hidden
        for_way = (lambda way: keep.setdefault(way, [])) if keep is not None else (lambda way: None)
        ahead = self._run("ahead", list(range(size)), data, valid, for_way("ahead"))
        back = self._run("back", list(range(size))[::-1], data, valid, for_way("back"))
        scores = ahead @ self.weights["out"][:h] + back @ self.weights["out"][h:] + self.weights["bias"]
        scores -= scores.max(axis=2, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=2, keepdims=True)
        if keep is not None:
            keep["states"] = np.concatenate([ahead, back], axis=2)
        return scores

    def gradients(self, data: np.ndarray, valid: np.ndarray, wanted: np.ndarray) -> tuple[float, dict]:
        """Mean loss per byte and its derivative by every weight, back through time."""
        keep: dict = {}
        found, total, h = self.labels(data, valid, keep), valid.sum(), self.hidden
        rows = np.arange(len(data))
        loss = -(np.log(found[:, rows, wanted] + 1e-9) * valid.T).sum() / total
        error = found.copy()
        error[:, rows, wanted] -= 1
        error *= (valid.T / total)[:, :, None].astype(np.float32)
        slopes = {"out": np.einsum("trh,trl->hl", keep["states"], error), "bias": error.sum(axis=(0, 1))}
        into = error @ self.weights["out"].T
        for part, way in enumerate(("ahead", "back")):
            inner = self.weights[f"{way}_state"]
            by_input, by_state = np.zeros_like(self.weights[f"{way}_in"]), np.zeros_like(inner)
            later = np.zeros((len(data), h), np.float32)
            for t, before, update, reset, new, carried in reversed(keep[way]):
                flow = (into[t, :, part * h : (part + 1) * h] + later) * valid[:, t, None]
                by_new = flow * (1 - update) * (1 - new * new)
                by_update = flow * (before - new) * update * (1 - update)
                by_reset = by_new * carried * reset * (1 - reset)
                gates = np.concatenate([by_update, by_reset, by_new], axis=1)
                np.add.at(by_input, data[:, t], gates)
                through = np.concatenate([by_update, by_reset, by_new * reset], axis=1)
                by_state += before.T @ through
                later = flow * update + through @ inner.T
            slopes[f"{way}_in"], slopes[f"{way}_state"] = by_input, by_state
        return float(loss), slopes

    def fit(self, texts: list[bytes], wanted: np.ndarray, *, rounds: int, batch: int = 192, rate: float = 0.02, seed: int = 2) -> float:
        """Adam over shuffled batches; returns the last batch's loss."""
        data, sizes, starts = cut_segments(texts)
        owner = np.repeat(np.arange(len(texts)), np.diff([*starts, len(data)]))
        rng, loss = np.random.default_rng(seed), float("nan")
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, rounds + 1):
            pick = rng.integers(0, len(data), min(batch, len(data)))
            valid = (np.arange(data.shape[1]) < sizes[pick, None]).astype(np.float32)
            loss, slopes = self.gradients(data[pick], valid, wanted[owner[pick]])
            pace = rate * min(1.0, 2 * (1 - step / (rounds + 1)))
            for name, slope in slopes.items():
                first[name] += 0.1 * (slope - first[name])
                second[name] += 0.01 * (slope * slope - second[name])
                scale = np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8
                self.weights[name] -= (pace * first[name] / (1 - 0.9**step) / scale).astype(np.float32)
        return loss

    def rows_at_once(self) -> int:
        return max(1, min(_ROWS, _ROWS * 64 // len(self.languages)))

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean probability of each language over all bytes of each text; texts aren't empty."""
        data, sizes, starts = cut_segments(texts)
        sums = np.zeros((len(data), len(self.languages)))
        rows = self.rows_at_once()
        for at in range(0, len(data), rows):
            part, size = data[at : at + rows], sizes[at : at + rows]
            valid = (np.arange(part.shape[1]) < size[:, None]).astype(np.float32)
            sums[at : at + rows] = np.einsum("trl,rt->rl", self.labels(part, valid), valid)
        lengths = np.array([len(t) for t in texts])
        return np.add.reduceat(sums, starts, axis=0) / lengths[:, None]


    def noise(self, texts: list[bytes]) -> np.ndarray:
        """Share of each text's bytes that the last class holds; bytes that no labelled text
        had count as held by none, as nothing was learnt of them."""
        data, sizes, starts = cut_segments(texts)
        sums = np.zeros(len(data))
        rows = self.rows_at_once()
        for at in range(0, len(data), rows):
            part, size = data[at : at + rows], sizes[at : at + rows]
            valid = (np.arange(part.shape[1]) < size[:, None]).astype(np.float32)
            sums[at : at + rows] = np.einsum("tr,rt->r", self.labels(part, valid)[:, :, -1], valid * self.known[part])
        return np.add.reduceat(sums, starts) / np.array([len(t) for t in texts])


# The operator -----------------------------------------------------------------


def id_remainder(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id is an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(parts))


def training_sample(
    labelled: DataFrame, *, per_language: int, pieces: int, max_rows: int, segment: int = SEGMENT
) -> list[tuple[str, bytes]]:
    """Segments of labelled texts of every language: ``pieces`` of each of at most
    ``per_language`` rows, of fewer rows where there are so many languages that these would
    be over ``max_rows``, but of one at least.

    ``labelled`` has ``id``, ``text``, ``lang``. Rows fall into slots by a hash of id, and
    the least hash of each slot is taken, so all rows take part and nothing but numbers
    is grouped. Of rows that repeat the id of a slot, one is taken after they are cut. The
    pieces are spread over the whole text.
    """
    slots = max(1, min(per_language, max_rows // max(1, labelled.select("lang").distinct().count())))
    slot, key = F.pmod(F.xxhash64("id"), F.lit(slots)), F.xxhash64("id", F.lit(1))
    # Only rows that have something to learn from compete for a slot.
    labelled = labelled.where(F.length("text") > 0)
    keyed = labelled.select("lang", "id", slot.alias("slot"), key.alias("key"))
    chosen = keyed.groupBy("lang", "slot").agg(F.min("key").alias("key"))
    chosen = F.broadcast(materialise(chosen))
    place = [
        (F.pmod(F.xxhash64("id", F.lit(k + 2)), F.greatest(F.length("text") - segment, F.lit(0)) + 1) + 1).cast("int")
        for k in range(pieces)
    ]
    rows = labelled.withColumns({"slot": slot, "key": key}).join(chosen, ["lang", "slot", "key"])
    cut = rows.select("lang", "slot", F.array(*[F.substring("text", at, F.lit(segment)) for at in place]).alias("cut"))
    one = cut.where("cut[0] <> ''").groupBy("lang", "slot").agg(F.min("cut").alias("cut"))
    found = one.select("lang", F.explode("cut").alias("piece")).where("piece <> ''")
    return [(lang, piece.encode()[:segment]) for lang, piece in sorted(found.collect())]


def noise_pieces(pieces: list[bytes], count: int, *, segment: int = SEGMENT, seed: int = 3) -> list[bytes]:
    """Texts in no language: letters of the pieces, each as likely as any other, in words of
    random lengths (a third in one word without an end, a third with capitals)."""
    letters = sorted({c for p in pieces for c in p.decode(errors="ignore") if c.isalpha()})
    small = sorted({c for c in letters if c.lower() == c}) or letters
    rng, found = np.random.default_rng(seed), []
    for i in range(count if letters else 0):
        drawn = rng.choice(letters if i % 3 == 0 else small, segment)
        if i % 3 != 1:
            drawn[rng.random(segment) < rng.uniform(0.05, 0.3)] = " "
        found.append("".join(drawn).encode()[:segment])
    return found


def train(
    docs: DataFrame,
    *,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 256,
    pieces: int = 8,
    max_rows: int = MAX_ROWS,
    rounds: int = 300,
    hidden: int = HIDDEN,
    seed: int = 1,
    noise: bool = False,
) -> Network | None:
    """A network for the languages of the rows that aren't held out; None without any.

    With ``noise`` it has one class more, the last: ``noise_pieces`` of the sample.
    """
    usable = ~held_out & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull()
    labelled = docs.where(usable).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    sample = training_sample(labelled, per_language=per_language, pieces=pieces, max_rows=max_rows)
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return None
    number = {lang: i for i, lang in enumerate(languages)}
    # Every language counts alike, however many rows it has.
    by_lang: dict[str, list[bytes]] = {lang: [] for lang in languages}
    for lang, piece in sample:
        by_lang[lang].append(piece)
    most = max(map(len, by_lang.values()))
    even = [(p, number[lang]) for lang, own in by_lang.items() for p in (own * -(-most // len(own)))[:most]]
    if noise:
        even += [(p, len(languages)) for p in noise_pieces([p for _, p in sample], most)]
    network = Network(languages + [NOISE] * noise, hidden, seed)
    network.known[list(set(b"".join(p for _, p in sample)))] = True
    rounds *= -(-len(languages) // 64)  # each language is seen as often, however many there are
    network.fit([p for p, _ in even], np.array([n for _, n in even]), rounds=rounds)
    return network


def has_letter(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))


def in_a_language(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    noise_share: float = NOISE_SHARE,
    **training,
) -> DataFrame:
    """``docs`` without the texts in no language.

    These are null texts, texts without a letter, and texts of which the network gives more
    than ``noise_share`` of the bytes to its class of random letters (``Network.noise``). It
    learns from the same rows as ``identify_languages``. Random letters of a script that no
    labelled text has stay, as does a text in such a script; of random texts shorter than
    about 200 letters some stay. When there is nothing to learn from, every text with a
    letter stays. Each row is judged by its own text, so null and repeated ids don't matter.
    """
    network = train(
        docs, held_out=id_remainder(id_col, 4) == 2, id_col=id_col, text_col=text_col, lang_col=lang_col, noise=True,
        **training,
    )
    lettered = docs.where(has_letter(text_col))
    if network is None:
        return lettered
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(network)

    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        plain = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
        usable = [i for i, t in enumerate(plain) if t]
        found = [False] * len(plain)
        if usable:
            for i, share in zip(usable, shared.value.noise([plain[i] for i in usable])):
                found[i] = bool(share <= noise_share)
        return pa.array(found, pa.bool_())

    return lettered.where(clean(F.col(text_col)))


def identify_languages(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **training
) -> DataFrame:
    """One row per document: ``id_col``, ``held_out``, ``lang_pred``, ``score``.

    Learns from the rows whose id's crc32 (of the id as text) modulo 4 isn't 2 and that
    have a language; predicts from whole texts alone. ``score`` is the mean probability
    of the language over all bytes. A text that is null or has no letter is ``und`` with
    score 0, and so is every text when there is nothing to learn from. A null id counts
    as an empty text for the split and isn't learnt from; repeated rows get equal results.
    """
    held = id_remainder(id_col, 4) == 2
    network = train(docs, held_out=held, id_col=id_col, text_col=text_col, lang_col=lang_col, **training)
    shared = docs.sparkSession.sparkContext.broadcast(network)
    kind = dict(docs.dtypes)[id_col]

    def predict(batches: Iterator[dict]) -> Iterator[dict]:
        network = shared.value
        for batch in batches:
            langs, scores = ["und"] * len(batch["held_out"]), [0.0] * len(batch["held_out"])
            usable = [i for i, letter in enumerate(batch["letter"]) if letter and network is not None]
            if usable:
                found = network.pooled([batch["text"][i] for i in usable])
                for i, row in zip(usable, found):
                    best = int(row.argmax())
                    langs[i], scores[i] = network.languages[best], min(1.0, float(row[best]))
            yield {id_col: batch[id_col], "held_out": batch["held_out"], "lang_pred": langs, "score": scores}

    letter = has_letter(text_col)
    table = docs.select(id_col, F.col(text_col).alias("text"), held.alias("held_out"), letter.alias("letter"))
    kinds = {id_col: kind, "text": "binary", "held_out": "boolean", "letter": "boolean"}
    return map_batches(table, kinds, predict, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double")
