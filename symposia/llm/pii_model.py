"""Character-level bidirectional LSTM with CRF transitions, in numpy: forward pass, decoding and gradients.

The network reads two characters at a time (the sum of an embedding of the first and one of the second) and scores the
tags of both, which halves its steps; the CRF runs over single characters. A sequence of odd length is padded by one."""

from __future__ import annotations

import io
import pkgutil
import unicodedata

import numpy as np

TYPES = ("email", "phone", "id_number", "address", "name")
TAGS = ("O", *(f"{p}-{t}" for t in TYPES for p in ("B", "I")))
N_TAGS = len(TAGS)
HIDDEN = 48
# characters: 95 printable ASCII, then classes of the others
_OTHER = {"pad": 95, "newline": 96, "space": 97, "lower": 98, "upper": 99, "digit": 100, "mark": 101, "rest": 102, "ss": 103, "invisible": 104}
VOCAB = 105
PAD = _OTHER["pad"]

#: Transitions a tag sequence can never make: into the inside of an item that has not begun.
FORBIDDEN = np.zeros((N_TAGS, N_TAGS), dtype=bool)
for _i, _a in enumerate(TAGS):
    for _j, _b in enumerate(TAGS):
        FORBIDDEN[_i, _j] = _b[0] == "I" and _a[2:] != _b[2:]
FORBIDDEN_START = np.array([t[0] == "I" for t in TAGS])


def _class_of(ch: str) -> int:
    code = ord(ch)
    if 32 <= code < 127:
        return code - 32
    if ch in "\n\r  \x0b\x0c\x85":
        return _OTHER["newline"]
    if ch == "ß":
        return _OTHER["ss"]
    folded = unicodedata.normalize("NFKD", ch)
    if len(folded) >= 1 and 32 < ord(folded[0]) < 127 and folded[0].isalnum():
        # accented and compatibility forms read as the plain character
        return ord(folded[0]) - 32
    if ch.isspace():
        return _OTHER["space"]
    kind = unicodedata.category(ch)
    return _OTHER[{"Ll": "lower", "Lu": "upper", "Lo": "lower", "Nd": "digit", "Mn": "mark", "Cf": "invisible"}.get(kind, "rest")]


_CODES: dict[str, int] = {}


def encode(text: str) -> np.ndarray:
    """Character classes of a text, one per code point."""
    codes = _CODES
    for ch in set(text):
        if ch not in codes:
            if len(codes) > 100_000:
                codes.clear()
            codes[ch] = _class_of(ch)
    return np.fromiter(map(codes.__getitem__, text), dtype=np.uint8, count=len(text))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def start_weights(seed: int = 1, hidden: int = HIDDEN) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w: dict[str, np.ndarray] = {}
    for side in "fb":
        w[f"x{side}1"] = rng.normal(0, 0.25, (VOCAB, 4 * hidden)).astype(np.float32)
        w[f"x{side}2"] = rng.normal(0, 0.25, (VOCAB, 4 * hidden)).astype(np.float32)
        w[f"h{side}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden)).astype(np.float32)
        w[f"x{side}1"][:, hidden : 2 * hidden] += 1.0  # forget gates start open
    w["out"] = rng.normal(0, 0.2, (2 * hidden, 2 * N_TAGS)).astype(np.float32)
    w["bias"] = np.zeros(2 * N_TAGS, np.float32)
    w["trans"] = rng.normal(0, 0.1, (N_TAGS, N_TAGS)).astype(np.float32)
    w["start"] = np.zeros(N_TAGS, np.float32)
    return w


def pairs_of(x: np.ndarray) -> np.ndarray:
    """Numbers of the character pairs (steps / 2, batch) of x (steps, batch), steps being even."""
    return x[0::2].astype(np.intp) * VOCAB + x[1::2]


def pair_table(w: dict[str, np.ndarray], side: str) -> np.ndarray:
    """What every pair of characters gives the gates of one direction."""
    return (w[f"x{side}1"][:, None, :] + w[f"x{side}2"][None, :, :]).reshape(VOCAB * VOCAB, -1)


def run_lstm(x: np.ndarray, table: np.ndarray, recur: np.ndarray, keep: bool = False):
    """Hidden states (steps, batch, hidden) over pair numbers x (steps, batch); with ``keep`` also what the gradients need."""
    steps, batch = x.shape
    hidden = recur.shape[0]
    h = np.zeros((batch, hidden), np.float32)
    c = np.zeros((batch, hidden), np.float32)
    out = np.empty((steps, batch, hidden), np.float32)
    cells = np.empty_like(out) if keep else None
    gates = np.empty((steps, batch, 4 * hidden), np.float32) if keep else None
    half = np.float32(0.5)
    for t in range(steps):
        z = table[x[t]]
        z += h @ recur
        s = z[:, : 3 * hidden]
        s *= half
        np.tanh(z, out=z)
        s *= half
        s += half
        c = z[:, hidden : 2 * hidden] * c + z[:, :hidden] * z[:, 3 * hidden :]
        h = z[:, 2 * hidden : 3 * hidden] * np.tanh(c)
        out[t] = h
        if keep:
            cells[t], gates[t] = c, z
    return (out, cells, gates) if keep else out


def lstm_gradients(x, d_out, out, cells, gates, recur):
    """Gradients of the two embeddings and of the recurrence; x are the characters (2 * steps, batch)."""
    steps, batch, hidden = out.shape
    d_recur = np.zeros_like(recur)
    dh, dc = np.zeros((batch, hidden), np.float32), np.zeros((batch, hidden), np.float32)
    dz_all = np.empty((steps, batch, 4 * hidden), np.float32)
    for t in range(steps - 1, -1, -1):
        dh = dh + d_out[t]
        g = gates[t]
        i, f, o, u = g[:, :hidden], g[:, hidden : 2 * hidden], g[:, 2 * hidden : 3 * hidden], g[:, 3 * hidden :]
        tc = np.tanh(cells[t])
        dc = dc + dh * o * (1 - tc * tc)
        before = cells[t - 1] if t else np.zeros_like(dc)
        dz = dz_all[t]
        dz[:, :hidden] = dc * u * i * (1 - i)
        dz[:, hidden : 2 * hidden] = dc * before * f * (1 - f)
        dz[:, 2 * hidden : 3 * hidden] = dh * tc * o * (1 - o)
        dz[:, 3 * hidden :] = dc * i * (1 - u * u)
        if t:
            d_recur += out[t - 1].T @ dz
        dh = dz @ recur.T
        dc = dc * f
    flat, tables = dz_all.reshape(-1, 4 * hidden), []
    for codes in (x[0::2].reshape(-1), x[1::2].reshape(-1)):
        d_table = np.zeros((VOCAB, 4 * hidden), np.float32)
        order = np.argsort(codes, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(codes[order].astype(int)) != 0])
        d_table[codes[order][starts]] = np.add.reduceat(flat[order], starts, axis=0)
        tables.append(d_table)
    return *tables, d_recur


def unpair(e: np.ndarray) -> np.ndarray:
    """Scores (steps, batch, 2 * tags) of pairs as scores (2 * steps, batch, tags) of characters."""
    steps, batch, _ = e.shape
    return e.reshape(steps, batch, 2, N_TAGS).transpose(0, 2, 1, 3).reshape(2 * steps, batch, N_TAGS)


def scores(forward: np.ndarray, backward: np.ndarray, w: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """What the two directions add to the tag scores of pairs. Each reads its own characters (steps, batch) from their
    first one, the backward ones being reversed by pairs, so that what pads the shorter sequences never comes first."""
    if "pf" not in w:
        hidden = w["hf"].shape[0]
        halved = np.r_[np.full(3 * hidden, 0.5, np.float32), np.ones(hidden, np.float32)]
        for side in "fb":
            w[f"p{side}"], w[f"r{side}"] = pair_table(w, side) * halved, w[f"h{side}"] * halved
    hidden = w["hf"].shape[0]
    return states(pairs_of(forward), w["pf"], w["rf"]) @ w["out"][:hidden] + w["bias"], states(pairs_of(backward), w["pb"], w["rb"]) @ w["out"][hidden:]


def states(x: np.ndarray, table: np.ndarray, recur: np.ndarray) -> np.ndarray:
    """``run_lstm`` for decoding: the gates' inputs come halved, as the sigmoid by tanh wants them, and buffers are reused."""
    steps, batch = x.shape
    hidden = recur.shape[0]
    out = np.zeros((steps + 1, batch, hidden), np.float32)
    c, z, again = np.zeros((batch, hidden), np.float32), np.empty((batch, 4 * hidden), np.float32), np.empty((batch, 4 * hidden), np.float32)
    gates, u, spare = z[:, : 3 * hidden], z[:, 3 * hidden :], np.empty((batch, hidden), np.float32)
    half = np.float32(0.5)
    for t in range(steps):
        np.take(table, x[t], axis=0, out=z, mode="clip")
        np.matmul(out[t], recur, out=again)
        z += again
        np.tanh(z, out=z)
        gates *= half
        gates += half
        c *= z[:, hidden : 2 * hidden]
        np.multiply(z[:, :hidden], u, out=spare)
        c += spare
        np.tanh(c, out=spare)
        np.multiply(z[:, 2 * hidden : 3 * hidden], spare, out=out[t + 1])
    return out[1:]


def one_thread() -> None:
    """Products this small gain nothing from more threads, which only spin; tasks already fill the cores."""
    import ctypes
    import glob
    import os

    for path in glob.glob(os.path.join(os.path.dirname(np.__file__), "..", "numpy.libs", "*openblas*")):
        library = ctypes.CDLL(path)
        for call in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, call):
                getattr(library, call)(1)
                break


def _masked(w: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.where(FORBIDDEN, np.float32(-1e4), w["trans"]), np.where(FORBIDDEN_START, np.float32(-1e4), w["start"])


def loss_and_gradients(x: np.ndarray, y: np.ndarray, w: dict[str, np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log likelihood per sequence of full-length sequences, and its gradients."""
    steps, batch = x.shape
    f_out, f_c, f_g = run_lstm(pairs_of(x), pair_table(w, "f"), w["hf"], keep=True)
    # pairs in reverse order, each with its characters in order
    xr = x.reshape(steps // 2, 2, batch)[::-1].reshape(steps, batch)
    b_out, b_c, b_g = run_lstm(pairs_of(xr), pair_table(w, "b"), w["hb"], keep=True)
    hidden = f_out.shape[2]
    both = np.concatenate([f_out, b_out[::-1]], axis=2)
    e = unpair(both @ w["out"] + w["bias"])
    trans, start = _masked(w)
    a = np.empty((steps, batch, N_TAGS), np.float32)
    a[0] = start + e[0]

    def lse(v, axis):
        m = v.max(axis=axis, keepdims=True)
        return np.squeeze(m, axis) + np.log(np.exp(v - m).sum(axis=axis))

    for t in range(1, steps):
        a[t] = lse(a[t - 1][:, :, None] + trans, 1) + e[t]
    z = lse(a[-1], 1)
    b = np.zeros((batch, N_TAGS), np.float32)
    d_e = np.empty_like(e)
    d_trans = np.zeros_like(trans)
    rows = np.arange(batch)
    for t in range(steps - 1, -1, -1):
        d_e[t] = np.exp(a[t] + b - z[:, None])
        if t:
            joint = np.exp(a[t - 1][:, :, None] + trans + (e[t] + b)[:, None, :] - z[:, None, None])
            d_trans += joint.sum(axis=0)
            b = lse(trans + (e[t] + b)[:, None, :], 2)
    score = start[y[0]] + e[0][rows, y[0]]
    for t in range(1, steps):
        score = score + trans[y[t - 1], y[t]] + e[t][rows, y[t]]
    loss = float((z - score).mean())
    d_start = d_e[0].sum(axis=0)
    np.subtract.at(d_start, y[0], 1)
    np.subtract.at(d_trans, (y[:-1].reshape(-1), y[1:].reshape(-1)), 1)
    d_e[np.arange(steps)[:, None], rows[None, :], y] -= 1
    d_e /= batch
    grads = {"trans": np.where(FORBIDDEN, 0, d_trans / batch).astype(np.float32), "start": np.where(FORBIDDEN_START, 0, d_start / batch).astype(np.float32)}
    d_e = d_e.reshape(steps // 2, 2, batch, N_TAGS).transpose(0, 2, 1, 3).reshape(steps // 2, batch, 2 * N_TAGS)
    grads["out"] = both.reshape(-1, 2 * hidden).T @ d_e.reshape(-1, 2 * N_TAGS)
    grads["bias"] = d_e.sum(axis=(0, 1))
    d_both = d_e @ w["out"].T
    grads["xf1"], grads["xf2"], grads["hf"] = lstm_gradients(x, np.ascontiguousarray(d_both[:, :, :hidden]), f_out, f_c, f_g, w["hf"])
    grads["xb1"], grads["xb2"], grads["hb"] = lstm_gradients(xr, np.ascontiguousarray(d_both[::-1, :, hidden:]), b_out, b_c, b_g, w["hb"])
    return loss, grads


def viterbi(e: np.ndarray, lengths: np.ndarray, w: dict[str, np.ndarray]) -> np.ndarray:
    """Best tag sequences (steps, batch) of emissions (steps, tags, batch) of sequences of rising ``lengths``."""
    trans, start = _masked(w)
    steps, _, batch = e.shape
    best = np.empty((steps, N_TAGS, batch), np.float32)
    best[0] = start[:, None] + e[0]
    across = trans[:, :, None]
    ways = np.empty((N_TAGS, N_TAGS, batch), np.float32)
    for t in range(1, steps):
        np.add(best[t - 1][:, None, :], across, out=ways)
        np.add(ways.max(axis=0), e[t], out=best[t])
    # the way back asks only for the predecessor of the one tag chosen
    tags = np.zeros((steps, batch), np.uint8)
    into, now, begun = np.ascontiguousarray(trans.T), np.zeros(batch, np.intp), batch
    for t in range(steps - 1, -1, -1):
        first = int(np.searchsorted(lengths, t + 1))
        if begun < batch:
            now[begun:] = (best[t][:, begun:] + into[now[begun:]].T).argmax(axis=0)
        if first < begun:
            now[first:begun] = best[t][:, first:begun].argmax(axis=0)
            begun = first
        tags[t, begun:] = now[begun:]
    return tags


def viterbi_blocks(blocks, w: dict[str, np.ndarray]) -> np.ndarray:
    """The best tags of one sequence given in blocks of emissions (steps, tags), which are dropped as they are read.

    What all ways back have in common is settled at the end of each block, so little more than a block is kept."""
    trans, start = _masked(w)
    done, held, score = [], np.empty((0, N_TAGS), np.uint8), None
    for e in blocks:
        back = np.zeros((len(e), N_TAGS), np.uint8)
        for t in range(len(e)):
            if score is None:
                score = start + e[t]
                continue
            ways = score[:, None] + trans
            back[t] = ways.argmax(axis=0)
            score = ways.max(axis=0) + e[t]
        held = np.concatenate([held, back])
        states, at = np.arange(N_TAGS), len(held)
        while at > 1 and (states != states[0]).any():
            at -= 1
            states = held[at][states]
        if at < len(held) and (states == states[0]).all():
            done.append(_walk(held[:at], int(states[0])))
            held = held[at:]
    if score is not None and len(held):
        done.append(_walk(held, int(score.argmax())))
    return np.concatenate(done) if done else np.empty(0, np.uint8)


def _walk(back: np.ndarray, last: int) -> np.ndarray:
    tags = np.empty(len(back), np.uint8)
    for t in range(len(back) - 1, -1, -1):
        tags[t] = last
        last = int(back[t][last])
    return tags


_WEIGHTS: dict[str, dict[str, np.ndarray]] = {}


def weights(name: str = "pii_weights.npz") -> dict[str, np.ndarray]:
    """The trained weights that come with the package, loaded once per worker."""
    if name not in _WEIGHTS:
        one_thread()
        data = pkgutil.get_data("symposia.llm", name)
        with np.load(io.BytesIO(data)) as stored:
            _WEIGHTS[name] = {k: stored[k].astype(np.float32) for k in stored.files}
    return _WEIGHTS[name]
