"""Character-level bidirectional LSTM with CRF transitions, trained and run in NumPy.

Tags are O and one per kind. Characters enter by a table of gate inputs; the gates are piecewise linear (clipped
to 0..1), which costs a fraction of exponentials. Texts are cut into overlapping windows, windows of all texts of a
batch go through the network side by side. The scores of a position are those of the window in which it stands
farthest from the edge; with these joined scores every window is decoded, so neighbours decode equal scores where they
overlap. From one window's path to the next one's it goes over where both have the same tag, nearest the edge between
them; windows without such a place are decoded as one. Spans are then runs of equal tags over the whole text.

A window is skipped by the decoder only where a bound proves its best path to be all O: a run of other tags, at
each position the best of them and with the dearest transitions, must lose against O wherever it begins and ends.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from vecquery.llm.pii_patterns import KINDS

HIDDEN = 8
TAGS = 1 + len(KINDS)
#: A window: CORE characters of its own and MARGIN shared with the neighbour on either side.
CORE = 512
MARGIN = 96
#: Longer texts are worked on in sections of so many windows, so memory does not follow the text.
SECTION = 4_096
#: Windows computed side by side.
SIDE = 1_024
#: ASCII each by itself, then letters of later blocks, other characters, and padding.
_LETTER, _OTHER, _PAD, CODES = 128, 129, 130, 131


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
    return _CODE_OF[np.minimum(points, len(_CODE_OF) - 1)]


_CODE_OF = np.array([i if i < 128 else _LETTER if chr(i).isalpha() else _OTHER for i in range(0x2000)], dtype=np.uint8)


@dataclass
class Network:
    """``table`` (2, codes, 4H), ``inner`` (2, H, 4H) for the two directions; gates i, f, o, g."""

    table: np.ndarray
    inner: np.ndarray
    out: np.ndarray  # (2, H, tags)
    bias: np.ndarray  # (tags,)
    step: np.ndarray  # (tags, tags)

    def parameters(self) -> list[np.ndarray]:
        return [self.table, self.inner, self.out, self.bias, self.step]


def new_network(seed: int = 0) -> Network:
    draw = np.random.default_rng(seed)
    h = HIDDEN
    table = draw.normal(0, 0.3, (2, CODES, 4 * h))
    table[:, :, : 3 * h] += 0.5
    table[:, :, h : 2 * h] += 0.3
    table[:, :, 3 * h :] += 0.5
    return Network(
        table, draw.normal(0, 0.25, (2, h, 4 * h)), draw.normal(0, 0.5, (2, h, TAGS)), np.zeros(TAGS),
        np.where(np.eye(TAGS, dtype=bool), 1.0, -1.0),
    )


def _states(net: Network, way: int, x: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states (T, B, H) of one direction over codes (T, B), and what the backward pass needs."""
    h = np.zeros((x.shape[1], HIDDEN))
    c = np.zeros_like(h)
    out, kept = np.empty((*x.shape, HIDDEN)), []
    n = HIDDEN
    for t, code in enumerate(x):
        raw = net.table[way][code] + h @ net.inner[way]
        gate = np.clip(raw, 0, 1)
        i, f, o, g = gate[:, :n], gate[:, n : 2 * n], gate[:, 2 * n : 3 * n], 2 * gate[:, 3 * n :] - 1
        new = f * c + i * g
        kept.append((code, h, c, raw, i, f, o, g, new))
        c = new
        h = o * np.clip(c, -1, 1)
        out[t] = h
    return out, kept


def _states_back(net: Network, way: int, kept: list, slope: np.ndarray, table: np.ndarray, inner: np.ndarray) -> None:
    """Adds the gradients of one direction to ``table`` and ``inner``; outside 0..1 a gate passes a little on."""
    dh = np.zeros(slope.shape[1:])
    dc = np.zeros_like(dh)
    for t in range(len(kept) - 1, -1, -1):
        code, h, c, raw, i, f, o, g, new = kept[t]
        dh = dh + slope[t]
        dc = dc + dh * o * np.where(np.abs(new) <= 1, 1.0, 0.05)
        dgate = np.concatenate([dc * g, dc * c, dh * np.clip(new, -1, 1), 2 * dc * i], axis=1)
        draw = dgate * np.where((raw >= 0) & (raw <= 1), 1.0, 0.05)
        np.add.at(table, code, draw)
        inner += h.T @ draw
        dh = draw @ net.inner[way].T
        dc = dc * f


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _crf(score: np.ndarray, step: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log likelihood of tags y (T, B) and its slopes by scores (T, B, K) and transitions."""
    length, width, k = score.shape
    ahead = np.empty_like(score)
    ahead[0] = score[0]
    for t in range(1, length):
        ahead[t] = score[t] + _log_sum(ahead[t - 1][:, :, None] + step, 1)
    behind = np.zeros_like(score)
    for t in range(length - 2, -1, -1):
        behind[t] = _log_sum(step + (score[t + 1] + behind[t + 1])[:, None, :], 2)
    total = _log_sum(ahead[-1], 1)
    dscore = np.exp(ahead + behind - total[:, None])
    pair = np.exp(
        ahead[:-1, :, :, None] + step + (score[1:] + behind[1:])[:, :, None, :] - total[None, :, None, None]
    ).sum(axis=(0, 1))
    rows = np.arange(width)
    path = sum(score[t, rows, y[t]].sum() for t in range(length)) + step[y[:-1], y[1:]].sum()
    for t in range(length):
        dscore[t, rows, y[t]] -= 1
    np.add.at(pair, (y[:-1], y[1:]), -1)
    return (total.sum() - path) / width, dscore / width, pair / width


def train(examples: list[tuple[np.ndarray, np.ndarray]], rounds: int = 300, side: int = 96, seed: int = 0) -> Network:
    """Adam on the CRF likelihood; an example is (codes, tags) of one common length."""
    net = new_network(seed)
    if not examples:
        return net
    x = np.array([e[0] for e in examples])
    y = np.array([e[1] for e in examples])
    draw = np.random.default_rng(seed)
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    for n in range(1, rounds + 1):
        some = draw.integers(len(x), size=min(side, len(x)))
        codes_, tags = x[some].T, y[some].T
        ahead, kept_a = _states(net, 0, codes_)
        behind, kept_b = _states(net, 1, codes_[::-1])
        both = (ahead, behind[::-1])
        score = both[0] @ net.out[0] + both[1] @ net.out[1] + net.bias
        _, dscore, dstep = _crf(score, net.step, tags)
        slopes = [np.zeros_like(p) for p in net.parameters()]
        for way in (0, 1):
            slopes[2][way] = np.einsum("tbh,tbk->hk", both[way], dscore)
        _states_back(net, 0, kept_a, dscore @ net.out[0].T, slopes[0][0], slopes[1][0])
        _states_back(net, 1, kept_b, (dscore @ net.out[1].T)[::-1], slopes[0][1], slopes[1][1])
        slopes[3], slopes[4] = dscore.sum(axis=(0, 1)), dstep
        size = np.sqrt(sum((s * s).sum() for s in slopes))
        rate = 0.03 * (1 - 0.9 * n / rounds)
        for p, s, m, v in zip(net.parameters(), slopes, first, second, strict=True):
            s = s * min(1.0, 5.0 / (size + 1e-12))
            m += 0.1 * (s - m)
            v += 0.01 * (s * s - v)
            p -= rate * (m / (1 - 0.9**n)) / (np.sqrt(v / (1 - 0.99**n)) + 1e-8)
    return net


class Tagger:
    """The network in 4-byte floats, feature by feature, for many windows side by side."""

    def __init__(self, net: Network):
        # rows are features, so that each gate of all windows is one block of memory
        self.table = [np.ascontiguousarray(t.T.astype(np.float32)) for t in net.table]
        self.inner = [np.ascontiguousarray(u.T.astype(np.float32)) for u in net.inner]
        self.out = [np.ascontiguousarray(w.T.astype(np.float32)) for w in net.out]
        self.bias = net.bias.astype(np.float32)[:, None]
        self.step = net.step.astype(np.float32)
        rest = self.step - self.step[0, 0]
        self.enter, self.leave, self.stay = rest[0, 1:].max(), rest[1:, 0].max(), rest[1:, 1:].max()

    def _run(self, way: int, x: np.ndarray, active: np.ndarray) -> np.ndarray:
        """States (T, H, B) over codes (T, B); columns are sorted by length, ``active[t]`` still run at t."""
        n = HIDDEN
        states = np.zeros((len(x), n, x.shape[1]), dtype=np.float32)
        h = np.zeros((n, x.shape[1]), dtype=np.float32)
        c = np.zeros_like(h)
        table, inner = self.table[way], self.inner[way]
        room = np.empty((4 * n, x.shape[1]), dtype=np.float32)
        for t in range(len(x)):
            w = active[t]
            if w < h.shape[1]:
                h, c = np.ascontiguousarray(h[:, :w]), np.ascontiguousarray(c[:, :w])
            gate = np.matmul(inner, h, out=room[:, :w] if w == h.shape[1] == room.shape[1] else None)
            gate += table.take(x[t, :w], axis=1, mode="clip")
            np.clip(gate, 0, 1, out=gate)
            i, g = gate[:n], gate[3 * n :]
            g += g
            g -= 1
            g *= i
            c *= gate[n : 2 * n]
            c += g
            np.clip(c, -1, 1, out=h)
            h *= gate[2 * n : 3 * n]
            states[t, :, :w] = h
        return states

    def _may_leave(self, score: np.ndarray, lengths: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Which windows a run of tags other than O may improve, by an upper bound on its gain."""
        gain = score[:, 1]
        for k in range(2, score.shape[1]):
            gain = np.maximum(gain, score[:, k])
        gain = gain - score[:, 0]
        run = gain[0].copy()  # the first position is entered without a transition
        top = np.maximum(run + self.leave, np.where(lengths == 1, run, -np.inf))
        for t in range(1, len(gain)):
            w = active[t]
            now = run[:w]
            now += self.stay
            np.maximum(now, self.enter, out=now)
            now += gain[t, :w]
            np.maximum(top[:w], now + self.leave, out=top[:w])
            last = active[t + 1] if t + 1 < len(gain) else 0  # from here on windows end at t
            np.maximum(top[last:w], now[last:], out=top[last:w])
        return top > 0

    def _decode(self, score: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best tags (T, B) for scores (T, K, B): positions past a window's end only repeat its last tag."""
        length, k, width = score.shape
        back = np.empty((length, k, width), dtype=np.int8)
        best = score[0].copy()
        same = np.arange(k, dtype=np.int8)[:, None]
        for t in range(1, length):
            new = np.empty_like(best)
            for j in range(k):
                came = best + self.step[:, j, None]
                top = came[0]
                at = back[t, j]
                at[:] = 0
                for i in range(1, k):
                    np.putmask(at, came[i] > top, i)
                    top = np.maximum(top, came[i])
                new[j] = top + score[t, j]
            over = t >= lengths
            back[t] = np.where(over, same, back[t])
            best = np.where(over, best, new)
        tags = np.empty((length, width), dtype=np.int8)
        tags[-1] = best.argmax(axis=0)
        cols = np.arange(width)
        for t in range(length - 1, 0, -1):
            tags[t - 1] = back[t, tags[t], cols]
        return tags

    def tags(self, texts: list[str], core: int = CORE, margin: int = MARGIN) -> list[np.ndarray]:
        """A tag for every character of every text."""
        room = core * SECTION
        if max(map(len, texts), default=0) <= room:
            return self._joined([codes(t) for t in texts], core, margin)
        out = []
        for text in texts:
            coded, parts = codes(text), [np.zeros(0, dtype=np.int8)]
            for a in range(0, len(coded), room):  # two windows more on either side have all that an edge depends on
                lo = max(0, a - 2 * core)
                part = self._joined([coded[lo : a + room + 2 * core]], core, margin)[0]
                parts.append(part[a - lo : a - lo + room])
            out.append(np.concatenate(parts))
        return out

    def _joined(self, coded: list[np.ndarray], core: int, margin: int) -> list[np.ndarray]:
        margin = min(margin, core)
        whole = np.concatenate([*coded, np.zeros(0, dtype=np.uint8)])
        result = np.zeros(len(whole), dtype=np.int8)
        ends = np.cumsum([len(c) for c in coded], dtype=np.int64)
        own, lo, hi, first = [], [], [], []
        for end, c in zip(ends.tolist(), coded, strict=True):
            begin = end - len(c)
            for a in range(begin, end, core):
                own.append(a)
                lo.append(max(begin, a - margin))
                hi.append(min(end, a + core + margin))
                first.append(a == begin)
        own, lo, hi = (np.array(v, dtype=np.int64) for v in (own, lo, hi))
        joined = np.empty((TAGS, len(whole)), dtype=np.float32)
        order = np.argsort(lo - hi, kind="stable")
        for s in range(0, len(order), SIDE):
            some = order[s : s + SIDE]
            score = self._scores(whole, lo[some], hi[some])
            for col, w in enumerate(some):
                a, z = own[w], min(own[w] + core, hi[w])
                joined[:, a:z] = score[a - lo[w] : z - lo[w], :, col].T
        found: dict[int, np.ndarray] = {}  # paths that may have other tags than O
        for s in range(0, len(order), SIDE):
            some = order[s : s + SIDE]
            score, lengths, active = self._gathered(joined, lo[some], hi[some])
            open_ = np.flatnonzero(self._may_leave(score, lengths, active))
            if len(open_):
                tags = self._decode(np.ascontiguousarray(score[:, :, open_]), lengths[open_])
                for col, w in enumerate(some[open_].tolist()):
                    found[w] = tags[: hi[w] - lo[w], col]
        for w in sorted(found):
            a, z = own[w], min(own[w] + core, hi[w])
            result[a:z] = found[w][a - lo[w] : z - lo[w]]
        self._reconcile(joined, result, found, own, lo, hi, first)
        return np.split(result, ends[:-1]) if len(coded) else []

    def _reconcile(
        self, joined: np.ndarray, result: np.ndarray, found: dict[int, np.ndarray], own: np.ndarray, lo: np.ndarray,
        hi: np.ndarray, first: list[bool],
    ) -> None:
        """Makes one path of the windows' paths; ``result`` has each window's own part."""
        apart: list[int] = []
        for w in sorted({v for w in found for v in (w, w + 1) if v < len(own) and not first[v]}):
            a, z, edge = lo[w], hi[w - 1], own[w]  # where the windows w - 1 and w overlap
            left = found[w - 1][a - lo[w - 1] :] if w - 1 in found else np.zeros(z - a, dtype=np.int8)
            right = found[w][: z - a] if w in found else np.zeros(z - a, dtype=np.int8)
            if (left == right).all():
                continue
            same = np.flatnonzero(left == right)
            if not len(same):
                apart.append(w)
                continue
            at = a + same[np.abs(a + same - edge).argmin()]
            if at < edge:
                result[at:edge] = right[at - a : edge - a]
            else:
                result[edge : at + 1] = left[edge - a : at + 1 - a]
        while apart:  # windows from begin to last in a row
            begin = last = apart.pop(0)
            while apart and apart[0] == last + 1:
                last = apart.pop(0)
            a, z = lo[begin - 1], hi[last]
            path = self._decode(joined[:, a:z].T[:, :, None].copy(), np.array([z - a]))[:, 0]
            a2, z2 = own[begin - 1], min(own[last + 1] if last + 1 < len(own) else z, z)
            result[a2:z2] = path[a2 - a : z2 - a]

    def _gathered(self, joined: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Joined scores (T, K, B) of windows lo..hi, sorted by length, their lengths and how many still run at each t."""
        lengths = hi - lo
        score = np.zeros((int(lengths[0]), TAGS, len(lo)), dtype=np.float32)
        for col, (a, z) in enumerate(zip(lo, hi, strict=True)):
            score[: z - a, :, col] = joined[:, a:z].T
        return score, lengths, (np.arange(len(score))[:, None] < lengths).sum(axis=1)

    def _scores(self, whole: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Scores (T, K, B) of the windows lo..hi, sorted by length."""
        lengths = hi - lo
        longest = int(lengths[0])
        t = np.arange(longest)[:, None]
        inside = t < lengths
        ahead = whole[np.where(inside, lo + t, 0)].astype(np.intp)
        turned = whole[np.where(inside, hi - 1 - t, 0)].astype(np.intp)
        active = inside.sum(axis=1)
        f = self._run(0, ahead, active)
        b = self._run(1, turned, active)
        score = self.out[0] @ f  # (T, K, B), one small product per position
        score += self.bias
        behind = self.out[1] @ b
        at = np.where(inside, lengths - 1 - t, 0)  # position t of a window is its reverse's
        columns = np.arange(len(lo))
        for k in range(TAGS):
            score[:, k] += behind[:, k][at, columns]
        return score


def runs(tags: np.ndarray) -> list[tuple[int, int, str]]:
    """Maximal runs of one kind: (start, end, kind)."""
    if not tags.any():
        return []
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(tags)) + 1, [len(tags)]])
    return [(int(a), int(z), KINDS[tags[a] - 1]) for a, z in zip(cuts, cuts[1:], strict=False) if tags[a]]
