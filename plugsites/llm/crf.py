"""A linear-chain conditional random field over word-shape features, in numpy.

Chains are runs of *marked* words: words with a digit or an @, spelled-out signs such as
"(at)" or "dot", and the few words before and after those. All other words can only be
outside of personal data, a constraint of the model that holds in training and decoding
alike; a chain is thus independent of all others, given the two words around it, and
texts need no further decoding.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np

from plugsites.llm.pii_rules import KINDS

#: Signs written out; the words next to them can belong to an address.
CUE = re.compile(r"(?i:[\[({](?:at|dot)[\])}]|(?<!\S)dot(?!\S))")
MARK = re.compile(rf"[0-9@]|{CUE.pattern}")
#: So many words before a cue and after it are marked, too, within so many characters.
BEFORE_CUE, AFTER_CUE, CUE_WINDOW = 3, 1, 80
WORD = re.compile(r"\S+")
BLANK = re.compile(r"\s")
SHAPE = re.compile(r"[A-Z]+|[a-z]+|[0-9]+|[^\W\d_]+|\s+|.", re.DOTALL)
OUTSIDE = 0
LABELS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
#: Words and shapes longer than this share the features of their first characters.
LONGEST_SHAPE = 40
#: Words up to this length are features themselves.
LONGEST_NAMED = 12


def begin(kind: int) -> int:
    return 1 + 2 * kind


def marked_words(text: str) -> list[tuple[int, int]]:
    """Bounds of the words that hold a digit, an @ or a cue, and of those near a cue."""
    words, at = [], 0
    while hit := MARK.search(text, at):
        start = hit.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        blank = BLANK.search(text, hit.end())
        end = blank.start() if blank else len(text)
        if CUE.search(text, start, end):
            low = max(words[-1][1] if words else 0, start - CUE_WINDOW)
            near = [match.span() for match in WORD.finditer(text, low, start)]
            if near and near[0][0] == low > 0 and not text[low - 1].isspace():
                near = near[1:]  # the window begins within it
            words += near[-BEFORE_CUE:]
            words.append((start, end))
            for match in list(WORD.finditer(text, end, min(len(text), end + CUE_WINDOW)))[:AFTER_CUE]:
                cut = match.end() == end + CUE_WINDOW and not text[match.end() : match.end() + 1].isspace()
                if not cut and not MARK.search(match.group()):
                    words.append(match.span())
                    end = match.end()
        else:
            words.append((start, end))
        at = end
    return words


def chains(text: str) -> list[list[tuple[int, int]]]:
    """Marked words with only white space between them, together."""
    runs: list[list[tuple[int, int]]] = []
    for word in marked_words(text):
        if runs and text[runs[-1][-1][1] : word[0]].isspace():
            runs[-1].append(word)
        else:
            runs.append([word])
    return runs


def core(text: str, word: tuple[int, int]) -> tuple[int, int]:
    """The word without punctuation around it; an opening plus sign stays."""
    start, end = word
    while start < end and not (text[start].isalnum() or text[start] == "+"):
        start += 1
    while end > start and not text[end - 1].isalnum():
        end -= 1
    return (start, end) if start < end else word


def shape(word: str) -> str:
    """Digits by number, letters by case: ``ab.12@x.de`` is ``x.d2@x.x``."""
    parts = []
    for part in SHAPE.findall(word[:LONGEST_SHAPE]):
        first = part[0]
        if first.isdigit():
            parts.append(f"d{len(part)}")
        elif first.isalpha():
            parts.append("X" if first.isupper() else "x")
        elif not first.isspace():
            parts.append(first)
    return "".join(parts)


def _around(text: str, at: int, step: int) -> tuple[str, str]:
    """Collapsed shape of the neighbouring word, empty at the text's ends, and the word."""
    window = text[at : at + 40] if step > 0 else text[max(0, at - 40) : at]
    words = window.split()
    word = words[0 if step > 0 else -1] if words else ""
    return re.sub(r"\d+", "", shape(word)), word


def _named(name: str, word: str) -> list[str]:
    """The word itself as a feature; numbers have their shapes only."""
    word = word.strip(":,;.").lower()
    known = word and len(word) <= LONGEST_NAMED and not any(map(str.isdigit, word))
    return [f"{name}={word}"] if known else []


def features(text: str, chain: list[tuple[int, int]]) -> list[list[str]]:
    """Features of each word of a chain, from the shapes of it and its neighbours."""
    cores = [core(text, word) for word in chain]
    shapes = [shape(text[start:end]) for start, end in cores]
    plain = [re.sub(r"\d+", "", one) for one in shapes]
    words = [text[start : min(end, start + 40)] for start, end in chain]
    (before, word_before), (after, word_after) = _around(text, chain[0][0], -1), _around(text, chain[-1][1], 1)
    out = []
    for k, (one, rough) in enumerate(zip(shapes, plain)):
        left = shapes[k - 1] if k else f"<{before}"
        right = shapes[k + 1] if k + 1 < len(chain) else f">{after}"
        digits = sum(map(str.isdigit, text[cores[k][0] : min(cores[k][1], cores[k][0] + 40)]))
        out.append(
            [
                "1",
                f"s={one}",
                f"r={rough}",
                f"n={digits}",
                f"l={left}",
                f"g={right}",
                f"l+r={left}|{rough}",
                f"r+g={rough}|{right}",
                f"@={'@' in rough}",
                f"+={rough[:1] == '+'}",
                *_named("w", words[k]),
                *_named("lw", words[k - 1] if k else word_before),
                *_named("rw", words[k + 1] if k + 1 < len(chain) else word_after),
                *(_named("rw2", words[k + 2]) if k + 2 < len(chain) else ()),
            ]
        )
    return out


def gold(chain: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[int]:
    """Labels of a chain's words under (start, kind, end) spans; the first span wins."""
    labels = [OUTSIDE] * len(chain)
    for start, kind, end in reversed(spans):
        inside = [k for k, (a, b) in enumerate(chain) if a < end and start < b]
        for n, k in enumerate(inside):
            labels[k] = begin(kind) + (n > 0)
    return labels


def _allowed() -> np.ndarray:
    """An inside label follows the begin or inside label of its kind only."""
    allowed = np.ones((LABELS, LABELS), bool)
    for kind in range(len(KINDS)):
        inside = begin(kind) + 1
        allowed[:, inside] = False
        allowed[[inside - 1, inside], inside] = True
    return allowed


NEVER = -1e9


@dataclass
class ChainField:
    """Weights of a trained field: emissions per feature, transitions, starts."""

    index: dict[str, int]
    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray

    def scores(self, sequences: list[list[list[str]]]) -> tuple[np.ndarray, np.ndarray]:
        """Emission scores of all words, chain after chain, and the chains' lengths."""
        lengths = np.array([len(sequence) for sequence in sequences], np.int64)
        out = np.zeros((int(lengths.sum()), LABELS))
        words = (word for sequence in sequences for word in sequence)
        for k, word in enumerate(words):
            known = [self.index[name] for name in word if name in self.index]
            if known:
                out[k] = self.emit[known].sum(axis=0)
        return out, lengths

    def decode(self, sequences: list[list[list[str]]]) -> list[list[int]]:
        """Viterbi over all chains at once: one numpy step per position, not per chain."""
        if not sequences:
            return []
        scores, lengths = self.scores(sequences)
        firsts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        order = np.argsort(-lengths, kind="stable")
        longest = int(lengths[order[0]])
        active = [int(np.searchsorted(-lengths[order], -t, side="left")) for t in range(longest)]
        best = self.start + scores[firsts[order]]
        back = []
        for t in range(1, longest):
            n = active[t]
            paths = best[:n, :, None] + self.move
            back.append(paths.argmax(axis=1).astype(np.int8))
            best[:n] = paths.max(axis=1) + scores[firsts[order[:n]] + t]
        labels: list[list[int]] = [[] for _ in sequences]
        last = best.argmax(axis=1)
        for rank, chain in enumerate(order):
            path = [int(last[rank])]
            for t in range(int(lengths[chain]) - 1, 0, -1):
                path.append(int(back[t - 1][rank, path[-1]]))
            labels[chain] = path[::-1]
        return labels


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


def train(
    sequences: list[list[list[str]]],
    labels: list[list[int]],
    rounds: int = 150,
    rate: float = 0.15,
    decay: float = 1e-3,
) -> ChainField | None:
    """Maximum penalised likelihood by full-batch Adam; None without chains.

    Forward and backward passes run over all chains of one length at once.
    """
    if not sequences:
        return None
    index: dict[str, int] = {}
    for sequence in sequences:
        for word in sequence:
            for name in word:
                index.setdefault(name, len(index))
    groups = defaultdict(list)
    for k, sequence in enumerate(sequences):
        groups[len(sequence)].append(k)
    width = max(len(word) for sequence in sequences for word in sequence)
    batches = []
    for length, members in groups.items():
        ids = np.full((len(members), length, width), len(index), np.int64)
        for row, k in enumerate(members):
            for t, word in enumerate(sequences[k]):
                ids[row, t, : len(word)] = [index[name] for name in word]
        batches.append((ids, np.array([labels[k] for k in members])))
    total = len(sequences)
    blocked = np.where(_allowed(), 0.0, NEVER)
    no_start = np.zeros(LABELS)
    no_start[2::2] = NEVER
    weights = [np.zeros((len(index) + 1, LABELS)), np.zeros((LABELS, LABELS)), np.zeros(LABELS)]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    for step in range(1, rounds + 1):
        emit, move, start = weights[0], weights[1] + blocked, weights[2] + no_start
        slopes = [decay * w for w in weights]
        for ids, truth in batches:
            count, length = truth.shape
            scores = emit[ids].sum(axis=2)
            forward = [start + scores[:, 0]]
            for t in range(1, length):
                forward.append(_log_sum(forward[-1][:, :, None] + move, 1) + scores[:, t])
            backward = [np.zeros((count, LABELS))]
            for t in range(length - 1, 0, -1):
                after = (scores[:, t] + backward[-1])[:, None, :]
                backward.append(_log_sum(move + after, 2))
            backward.reverse()
            whole = _log_sum(forward[-1], 1)[:, None]
            for t in range(length):
                miss = np.exp(forward[t] + backward[t] - whole)
                miss[np.arange(count), truth[:, t]] -= 1
                for feature in range(width):
                    np.add.at(slopes[0], ids[:, t, feature], miss / total)
                if t == 0:
                    slopes[2] += miss.sum(axis=0) / total
                else:
                    pair = (
                        forward[t - 1][:, :, None]
                        + move
                        + (scores[:, t] + backward[t])[:, None, :]
                        - whole[:, :, None]
                    )
                    pair = np.exp(pair).sum(axis=0)
                    np.subtract.at(pair, (truth[:, t - 1], truth[:, t]), 1)
                    slopes[1] += pair / total
        slopes[0][-1] = 0
        for w, g, m, v in zip(weights, slopes, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return ChainField(index, weights[0][:-1], weights[1] + blocked, weights[2] + no_start)


def predicted_spans(
    text: str, chain: list[tuple[int, int]], labels: list[int]
) -> list[tuple[int, int, int]]:
    """(start, kind, end) of each begin label with the inside labels after it."""
    spans: list[tuple[int, int, int]] = []
    for word, label in zip(chain, labels):
        if label == OUTSIDE:
            continue
        start, end = core(text, word)
        kind = (label - 1) // 2
        if label % 2:
            spans.append((start, kind, end))
        else:
            spans[-1] = (spans[-1][0], kind, end)
    return spans
