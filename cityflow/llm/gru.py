"""A small bidirectional gated recurrent network with attention pooling, in numpy.

Words come in as a sum of two learned inputs: one of the word as a whole and the mean of those of its
character runs of three to five, with marks at both ends of the word. Both are looked up by hash, and start at zero, so
what training has not seen adds nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

WORD_BITS, GRAM_BITS = 18, 18
INPUT, HIDDEN = 8, 8
GRAMS = (3, 4, 5)
#: Words that are worked on together.
BLOCK = 16_384

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(1099511628211)


def _mixed(values: np.ndarray, bits: int) -> np.ndarray:
    values = (values ^ (values >> np.uint64(29))) * _MIX
    return (values >> np.uint64(64 - bits)).astype(np.int32)


@dataclass
class WordInputs:
    """Hashes of distinct words: one for each word, and those of its character runs one after the other."""

    words: np.ndarray
    grams: np.ndarray
    begins: np.ndarray  # where the runs of a word begin
    counts: np.ndarray


def word_inputs(words: list[bytes]) -> WordInputs:
    """Hashes of words; a word is marked at both ends, so that even an empty one has a character run."""
    parts = [_hashed(words[at : at + BLOCK]) for at in range(0, len(words), BLOCK)]
    if not parts:
        empty = np.empty(0, dtype=np.int64)
        return WordInputs(empty, empty, empty, empty)
    counts = np.concatenate([p.counts for p in parts])
    return WordInputs(
        np.concatenate([p.words for p in parts]), np.concatenate([p.grams for p in parts]), np.cumsum(counts) - counts, counts
    )


def _hashed(words: list[bytes]) -> WordInputs:
    """Hashes of some words."""
    data = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), dtype=np.uint8).astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), dtype=np.int64, count=len(words))
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(data)) - np.repeat(begins, lengths)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(lengths.max()), _BASE, dtype=np.uint64))
        whole = np.add.reduceat((data + np.uint64(1)) * powers[place], begins)
        left = np.repeat(lengths, lengths) - place
        hashes, owners = [], []
        owner = np.repeat(np.arange(len(words)), lengths)
        for n in GRAMS:
            at = np.flatnonzero(left >= n)
            value = np.full(len(at), n, dtype=np.uint64)
            for k in range(n):
                value = value * _BASE + data[at + k] + np.uint64(1)
            hashes.append(_mixed(value, GRAM_BITS))
            owners.append(owner[at])
        # Words of one character have a run of three with their marks; the empty word takes its own hash.
        short = np.flatnonzero(lengths < GRAMS[0])
        hashes.append(_mixed(whole[short], GRAM_BITS))
        owners.append(short)
        words_at = _mixed(whole, WORD_BITS)
    owners_all, hashes_all = np.concatenate(owners), np.concatenate(hashes)
    order = np.argsort(owners_all, kind="stable")
    counts = np.bincount(owners_all, minlength=len(words))
    return WordInputs(words_at, hashes_all[order], np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)


@dataclass
class Windows:
    """Windows over numbered words, longest first: `ids` is (step, window), `lengths` words are real."""

    ids: np.ndarray
    lengths: np.ndarray
    owners: np.ndarray  # the text each window is of

    @property
    def active(self) -> np.ndarray:
        """How many windows have a word at each step."""
        return len(self.lengths) - np.searchsorted(self.lengths[::-1], np.arange(len(self.ids)), side="right")


def windows(texts: list[np.ndarray], width: int, stride: int) -> Windows:
    """All overlapping windows of texts of word numbers; a text without words has none."""
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    many = np.where(sizes > 0, np.maximum(1, -(-(sizes - (width - stride)) // stride)), 0)
    owners = np.repeat(np.arange(len(texts)), many)
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    begin = nth * stride
    lengths = np.minimum(width, sizes[owners] - begin)
    order = np.argsort(-lengths, kind="stable")
    owners, begin, lengths = owners[order], begin[order], lengths[order]
    flat = np.concatenate([*texts, np.zeros(width, dtype=np.int64)]) if texts else np.zeros(width, dtype=np.int64)
    first = (np.cumsum(sizes) - sizes)[owners] + begin if len(texts) else begin
    steps = np.arange(int(lengths[0]) if len(lengths) else 0)[:, None]
    ids = np.where(steps < lengths, flat[np.minimum(first + steps, len(flat) - 1)], 0)
    return Windows(ids, lengths, owners)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


@dataclass
class Network:
    """Weights by name; tables of words and character runs among them."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, seed: int = 7) -> Network:
        """An untrained network."""
        rng = np.random.default_rng(seed)

        def drawn(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) * 0.3).astype(np.float32)

        return cls(
            {
                "words": np.zeros((1 << WORD_BITS, INPUT), np.float32),
                "grams": np.zeros((1 << GRAM_BITS, INPUT), np.float32),
                "in": drawn(INPUT, 6 * HIDDEN),
                "in0": np.zeros(6 * HIDDEN, np.float32),
                "forth": drawn(HIDDEN, 3 * HIDDEN),
                "back": drawn(HIDDEN, 3 * HIDDEN),
                "look": drawn(2 * HIDDEN),
                "out": drawn(2 * HIDDEN),
                "out0": np.zeros(1, np.float32),
            }
        )

    def embedded(self, inputs: WordInputs) -> np.ndarray:
        """Input of each distinct word."""
        w = self.weights
        if not len(inputs.words):
            return np.zeros((0, INPUT), np.float32)
        out = w["words"][inputs.words]
        ends = inputs.begins + inputs.counts
        # A block at a time: the character runs of all words at once would take several hundred MB.
        for at in range(0, len(out), BLOCK):
            begins, counts = inputs.begins[at : at + BLOCK], inputs.counts[at : at + BLOCK, None].astype(np.float32)
            rows = w["grams"][inputs.grams[begins[0] : ends[at : at + BLOCK][-1]]]
            out[at : at + BLOCK] += np.add.reduceat(rows, begins - begins[0], axis=0) / counts
        return out

    def _run(self, given: np.ndarray, ids: np.ndarray, active: np.ndarray, u: np.ndarray, trace: list | None) -> np.ndarray:
        """States after each step; `given` is what the words add to the gates."""
        steps, many = ids.shape
        states = np.zeros((steps, many, HIDDEN), np.float32)
        h = np.zeros((many, HIDDEN), np.float32)
        for t in range(steps):
            n = active[t]
            x, was = given[ids[t, :n]], h[:n]
            inner = was @ u
            gates = _sigmoid(x[:, : 2 * HIDDEN] + inner[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            new = np.tanh(x[:, 2 * HIDDEN :] + r * inner[:, 2 * HIDDEN :])
            if trace is not None:
                trace.append((was.copy(), z, r, new, inner[:, 2 * HIDDEN :]))
            h[:n] = new + z * (was - new)
            states[t, :n] = h[:n]
        return states

    def forward(self, x: np.ndarray, batch: Windows, trace: dict | None = None) -> np.ndarray:
        """Logit of each window; `x` is the input of each distinct word."""
        w = self.weights
        given = x @ w["in"] + w["in0"]
        active = batch.active
        steps, many = batch.ids.shape
        turned = np.maximum(batch.lengths - 1 - np.arange(steps)[:, None], 0)
        column = np.arange(many)
        back_ids = batch.ids[turned, column]
        traces: tuple[list | None, list | None] = ([], []) if trace is not None else (None, None)
        forth = self._run(given[:, : 3 * HIDDEN], batch.ids, active, w["forth"], traces[0])
        back = self._run(given[:, 3 * HIDDEN :], back_ids, active, w["back"], traces[1])[turned, column]
        both = np.concatenate([forth, back], axis=2)
        seen = np.arange(steps)[:, None] < batch.lengths
        look = np.where(seen, both @ w["look"], -1e9)
        look = np.exp(look - look.max(axis=0))
        look = np.where(seen, look, 0)
        look /= look.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", look, both)
        if trace is not None:
            trace |= {"active": active, "turned": turned, "back_ids": back_ids, "traces": traces, "both": both, "look": look, "pooled": pooled, "given": given}
        return pooled @ w["out"] + w["out0"][0]

    def gradients(self, x: np.ndarray, batch: Windows, target: np.ndarray, weight: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
        """Gradients of the weights and of `x`, and the loss (weighted cross-entropy)."""
        w, trace = self.weights, {}
        logits = self.forward(x, batch, trace)
        chance = _sigmoid(logits)
        loss = float(-(weight * np.where(target > 0.5, np.log(chance + 1e-7), np.log(1 - chance + 1e-7))).sum())
        d_logit = ((chance - target) * weight).astype(np.float32)
        both, look, pooled = trace["both"], trace["look"], trace["pooled"]
        grads = {"out": pooled.T @ d_logit, "out0": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * w["out"]
        d_look = np.einsum("tbh,bh->tb", both, d_pooled)
        d_score = look * (d_look - (look * d_look).sum(axis=0))
        grads["look"] = np.einsum("tb,tbh->h", d_score, both)
        d_both = look[:, :, None] * d_pooled + d_score[:, :, None] * w["look"]
        steps, many = batch.ids.shape
        d_given = np.zeros_like(trace["given"])
        column = np.arange(many)
        d_back = np.zeros_like(d_both[:, :, HIDDEN:])
        seen = np.arange(steps)[:, None] < batch.lengths
        t_at, b_at = np.nonzero(seen)
        d_back[trace["turned"][t_at, b_at], b_at] = d_both[t_at, b_at, HIDDEN:]
        for name, part, d_states, ids in (("forth", 0, d_both[:, :, :HIDDEN], batch.ids), ("back", 1, d_back, trace["back_ids"])):
            u = w[name]
            d_u = np.zeros_like(u)
            d_h = np.zeros((many, HIDDEN), np.float32)
            columns = slice(part * 3 * HIDDEN, (part + 1) * 3 * HIDDEN)
            at, changes = [], []
            for t in range(steps - 1, -1, -1):
                n = trace["active"][t]
                was, z, r, new, inner = trace["traces"][part][t]
                d = d_h[:n] + d_states[t, :n]
                d_new = d * (1 - z) * (1 - new * new)
                d_z = d * (was - new) * z * (1 - z)
                d_r = d_new * inner * r * (1 - r)
                d_gate = np.concatenate([d_z, d_r, d_new], axis=1)
                d_inner = np.concatenate([d_z, d_r, d_new * r], axis=1)
                d_u += was.T @ d_inner
                d_h[:n] = d * z + d_inner @ u.T
                at.append(ids[t, :n])
                changes.append(d_gate)
            np.add.at(d_given[:, columns], np.concatenate(at), np.concatenate(changes))
            grads[name] = d_u
        del column
        grads["in"] = x.T @ d_given
        grads["in0"] = d_given.sum(axis=0)
        return grads, d_given @ w["in"].T, loss


@dataclass
class Trainer:
    """Adam for the dense weights, and steps scaled by each row's past gradients for the tables."""

    network: Network
    rate: float = 0.01
    table_rate: float = 0.1
    #: Rows of the tables that may learn; None is all.
    open_rows: dict[str, np.ndarray] | None = None
    #: Share of the words of a batch that are blanked, so that no single one carries a text.
    blanked: float = 0.3
    rng: np.random.Generator = field(default_factory=lambda: np.random.default_rng(5))
    state: dict = field(default_factory=dict)
    steps: int = 0

    def step(self, inputs: WordInputs, batch: Windows, target: np.ndarray, weight: np.ndarray) -> float:
        """One update on windows of the distinct words in `inputs`; returns the loss."""
        net = self.network
        kept = ((self.rng.random(len(inputs.words)) >= self.blanked) / (1 - self.blanked)).astype(np.float32)[:, None]
        grads, d_x, loss = net.gradients(net.embedded(inputs) * kept, batch, target, weight)
        d_x *= kept
        self.steps += 1
        for name, g in grads.items():
            m, v = self.state.setdefault(name, (np.zeros_like(g), np.zeros_like(g)))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            m_hat, v_hat = m / (1 - 0.9**self.steps), v / (1 - 0.99**self.steps)
            net.weights[name] -= (self.rate * m_hat / (np.sqrt(v_hat) + 1e-8)).astype(np.float32)
        self._rows("words", inputs.words, d_x)
        share = d_x / inputs.counts[:, None].astype(np.float32)
        self._rows("grams", inputs.grams, np.repeat(share, inputs.counts, axis=0))
        return loss

    def _rows(self, name: str, rows: np.ndarray, change: np.ndarray) -> None:
        if self.open_rows is not None:
            may = self.open_rows[name][rows]
            rows, change = rows[may], change[may]
        touched, place = np.unique(rows, return_inverse=True)
        total = np.zeros((len(touched), INPUT), np.float32)
        np.add.at(total, place, change)
        past = self.state.setdefault(name, np.full(len(self.network.weights[name]), 1e-6, np.float32))
        past[touched] += (total * total).mean(axis=1)
        self.network.weights[name][touched] -= self.table_rate * total / np.sqrt(past[touched])[:, None]
