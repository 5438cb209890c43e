"""Character-level bidirectional LSTM with CRF transitions, in numpy.

A small tagger over windows of characters.  Gates and cell outputs are clipped
linear functions, so a step is a handful of array operations over all windows
of a batch.  Training is maximum likelihood of the tag sequence (forward and
backward sums of the CRF, back-propagation through time, Adam).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

KINDS = ("email", "ip", "card", "phone")          # tag k + 1 is KINDS[k]; tag 0 is outside
TAGS = len(KINDS) + 1
ALPHABET = 131
OTHER_CHAR, WIDE_CHAR, PAD = 128, 129, 130
HIDDEN = 8


def codes(text: str) -> np.ndarray:
    """Character codes: ASCII as it is, other letters, anything else."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(cp < 128, cp, np.where(cp < 0x250, OTHER_CHAR, WIDE_CHAR)).astype(np.uint8)


@dataclass
class Tagger:
    table: np.ndarray       # (2, 4, ALPHABET, H): a character's input to the gates, by direction
    inner: np.ndarray       # (2, 4, H, H)
    out: np.ndarray         # (2, H, TAGS)
    bias: np.ndarray        # (TAGS,)
    trans: np.ndarray       # (TAGS, TAGS): from, to
    first: np.ndarray       # (TAGS,)

    @staticmethod
    def new(hidden: int = HIDDEN, seed: int = 3) -> Tagger:
        rng = np.random.default_rng(seed)
        table = rng.normal(0, 0.15, (2, 4, ALPHABET, hidden))
        table[:, 0] += 0.5
        table[:, 1] += 0.7
        table[:, 2] += 0.5
        inner = rng.normal(0, 0.25 / np.sqrt(hidden), (2, 4, hidden, hidden))
        out = rng.normal(0, 0.5, (2, hidden, TAGS))
        return Tagger(*(x.astype(np.float32) for x in (
            table, inner, out, np.zeros(TAGS), np.zeros((TAGS, TAGS)), np.zeros(TAGS))))

    def params(self) -> list[np.ndarray]:
        return [self.table, self.inner, self.out, self.bias, self.trans, self.first]

    def emissions(self, chars: np.ndarray, keep: list | None = None) -> np.ndarray:
        """(T, N) character codes -> (T, N, TAGS) tag scores.  ``keep`` gets
        what the backward pass needs."""
        steps, n = chars.shape
        hidden = self.inner.shape[-1]
        both = np.stack([chars, chars[::-1]], axis=1)
        e = np.empty((2, steps, n, TAGS), np.float32)
        h = np.zeros((2, 1, n, hidden), np.float32)
        c = np.zeros((2, n, hidden), np.float32)
        g = np.empty((2, 4, n, hidden), np.float32)
        m = np.empty_like(g)
        for t in range(steps):
            for d in range(2):
                for k in range(4):
                    np.take(self.table[d, k], both[t, d], axis=0, out=g[d, k], mode="clip")
            np.matmul(h, self.inner, out=m)
            g += m
            if keep is not None:
                keep.append((h.copy(), c.copy(), g.copy()))
            np.clip(g[:, :3], 0, 1, out=g[:, :3])
            cand = np.clip(g[:, 3], -1, 1, out=g[:, 3])
            c *= g[:, 1]
            cand *= g[:, 0]
            c += cand
            np.clip(c, -1, 1, out=cand)
            np.multiply(cand, g[:, 2], out=h[:, 0])
            np.matmul(h[:, 0], self.out, out=e[:, t])
            if keep is not None:
                keep[-1] += (h.copy(), c.copy())
        out = e[0]
        out += e[1, ::-1]
        out += self.bias
        return out

    def decode(self, e: np.ndarray) -> np.ndarray:
        """Most likely tags (T, N).

        A window in which no step can gain from leaving tag 0, whatever the
        transitions, is all 0 and is not walked.
        """
        steps, n, _ = e.shape
        tags = np.zeros((steps, n), np.uint8)
        gain = max(float((self.trans - self.trans[0, 0]).max()), float((self.first - self.first[0]).max()), 0.0)
        open_ = np.flatnonzero(((e[:, :, 1:].max(axis=2) - e[:, :, 0]) > -2 * gain).any(axis=0))
        if not len(open_):
            return tags
        e = e[:, open_]
        best = e[0] + self.first
        back = np.empty((steps, len(open_), TAGS), np.uint8)
        for t in range(1, steps):
            score = best[:, :, None] + self.trans
            back[t] = score.argmax(axis=1)
            best = score.max(axis=1) + e[t]
        at = best.argmax(axis=1)
        rows = np.arange(len(open_))
        tags[steps - 1, open_] = at
        for t in range(steps - 1, 0, -1):
            at = back[t, rows, at]
            tags[t - 1, open_] = at
        return tags

    def gradient(self, chars: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log-likelihood of the tags and its gradient."""
        steps, n = chars.shape
        keep: list = []
        e = self.emissions(chars, keep).astype(np.float64)
        alpha = np.empty_like(e)
        beta = np.zeros_like(e)

        def lse(x, axis):
            top = x.max(axis=axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))

        alpha[0] = e[0] + self.first
        for t in range(1, steps):
            alpha[t] = lse(alpha[t - 1][:, :, None] + self.trans, 1) + e[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = lse(self.trans[None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        z = lse(alpha[-1], 1)
        post = np.exp(alpha + beta - z[None, :, None])
        gold = np.eye(TAGS)[tags]
        de = ((post - gold) / n).astype(np.float32)
        pair = np.zeros((TAGS, TAGS))
        for t in range(1, steps):
            pair += np.exp(alpha[t - 1][:, :, None] + self.trans + (e[t] + beta[t] - z[:, None])[:, None, :]).sum(axis=0)
        np.subtract.at(pair, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        right = (e * gold).sum() + self.trans[tags[:-1], tags[1:]].sum() + self.first[tags[0]].sum()
        loss = (z.sum() - right) / n
        d_table, d_inner, d_out = map(np.zeros_like, (self.table, self.inner, self.out))
        both = np.stack([chars, chars[::-1]], axis=1)
        de2 = np.stack([de, de[::-1]], axis=1)                    # (T, 2, N, TAGS)
        hidden = self.inner.shape[-1]
        dh = np.zeros((2, n, hidden), np.float32)
        dc = np.zeros_like(dh)
        every = np.empty((steps, 2, 4, n, hidden), np.float32)
        for t in range(steps - 1, -1, -1):
            h0, c0, raw, h1, c1 = keep[t]
            d_out += np.matmul(h1[:, 0].transpose(0, 2, 1), de2[t])
            dh += np.matmul(de2[t], self.out.transpose(0, 2, 1))
            i, f, o = (np.clip(raw[:, k], 0, 1) for k in range(3))
            cand = np.clip(raw[:, 3], -1, 1)
            dc += dh * o * (np.abs(c1) < 1)
            dg = every[t]
            dg[:, 0], dg[:, 1], dg[:, 3] = dc * cand, dc * c0, dc * i
            dg[:, 2] = dh * np.clip(c1, -1, 1)
            dg[:, :3] *= (raw[:, :3] > 0) & (raw[:, :3] < 1)
            dg[:, 3] *= np.abs(raw[:, 3]) < 1
            d_inner += np.matmul(h0.transpose(0, 1, 3, 2), dg)
            dh = np.matmul(dg, self.inner.transpose(0, 1, 3, 2)).sum(axis=1)
            dc = dc * f
        for d in range(2):
            flat = both[:, d].ravel()
            order = np.argsort(flat, kind="stable")
            chars_seen, starts = np.unique(flat[order], return_index=True)
            rows = every[:, d].transpose(0, 2, 1, 3).reshape(steps * n, 4 * hidden)[order]
            d_table[d][:, chars_seen] = np.add.reduceat(rows, starts).reshape(-1, 4, hidden).transpose(1, 0, 2)
        d_first = (post[0] - gold[0]).sum(axis=0) / n
        return float(loss), [d_table, d_inner, d_out, de.sum(axis=(0, 1)), (pair / n).astype(np.float32),
                             d_first.astype(np.float32)]


def train(chars: np.ndarray, tags: np.ndarray, steps: int = 300, batch: int = 128, rate: float = 0.02,
          seed: int = 5, hidden: int = HIDDEN) -> Tagger:
    """Fit on (n, T) windows with their tags."""
    rng = np.random.default_rng(seed)
    model = Tagger.new(hidden)
    first = [np.zeros_like(p) for p in model.params()]
    second = [np.zeros_like(p) for p in model.params()]
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(chars), min(batch, len(chars)))
        _, grads = model.gradient(chars[pick].T, tags[pick].T)
        size = np.sqrt(sum(float((g * g).sum()) for g in grads))
        scale = min(1.0, 5.0 / max(size, 1e-9))
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, a, b in zip(model.params(), grads, first, second):
            g = g * scale
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= now * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return model
