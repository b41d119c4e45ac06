"""Language ID by cross-parsing: fewest phrases of a language's own substrings.

A suffix automaton per language holds every substring of a bounded labelled
sample.  A text is cut into phrases, each the longest match from where the last
one ended; phrases * log2(sample size) / characters is the cross-parsing
entropy, and the language with the least wins.  The automata are one transition
table, in which a missing transition already is the restart of the next phrase,
so many text segments and all languages step through it together in numpy.  The
table holds the frequent characters; transitions of all other characters of the
samples are a sorted list beside it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import share, shared_value

#: Labelled rows per language, characters of each, and characters of all languages
#: together: with LANGUAGES the bounds of the sample that is collected for training.
SAMPLE_ROWS = 64
SAMPLE_CHARS = 1_000
TOTAL_CHARS = 200_000
LANGUAGE_CHARS = 40_000
#: Characters in the table; the others of the samples are looked up in the sorted
#: list.  Only a character of no sample is a phrase by itself in every language.
ALPHABET = 95
#: Languages learned at most, the most frequent ones.
LANGUAGES = 500
#: Characters of a segment: the segments of a text are parsed side by side.
SEGMENT = 1_024
#: Segments that step together, and (segment, language) pairs with their characters.
LANES = 4_096
CELLS = 1 << 24
_RESTART = np.int32(1 << 30)
_BETWEEN = re.compile(r"[\W\d_]+")


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the start."""
    nexts, link, length, last = [{}], [-1], [0], 0
    for c in codes:
        cur = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nexts


def plain(text: str) -> str:
    """Lower-case letters with one space for anything between them."""
    return _BETWEEN.sub(" ", text.lower())


class CrossParser:
    """Automata of all languages, as one sparse list of transitions."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        room = min(LANGUAGE_CHARS, TOTAL_CHARS // max(1, len(samples)))
        texts = {name: plain(samples[name])[:room] for name in self.languages}
        chars, counts = np.unique(list("".join(texts.values())), return_counts=True)
        ranked = chars[np.argsort(-counts, kind="stable")].tolist()
        self.chars, self.rare = sorted(ranked[:ALPHABET]), sorted(ranked[ALPHABET:])
        code = {c: i + 1 for i, c in enumerate(self.chars + self.rare)}
        self.sizes = [max(2, len(texts[name])) for name in self.languages]
        self.roots, parts, base = [], [], 0
        for name in self.languages:
            nexts = suffix_automaton([code.get(c, 0) for c in texts[name]])
            rows = [(s, c, t) for s, to in enumerate(nexts) for c, t in to.items() if c]
            parts.append(np.array(rows or [(0, 1, 0)][:0], np.int32).reshape(-1, 3) + [base, 0, base])
            self.roots.append(base)
            base += len(nexts)
        self.states = base
        moves = np.concatenate(parts).astype(np.int32) if parts else np.empty((0, 3), np.int32)
        dense = moves[:, 1] <= len(self.chars)
        self.moves, others = moves[dense], moves[~dense].astype(np.int64)
        #: Transitions of the rare characters, sorted by state and character.
        keys = others[:, 0] * self._width() + others[:, 1]
        order = np.argsort(keys)
        self.keys, self.targets = keys[order], others[order, 2].astype(np.int32)

    def _width(self) -> int:
        return len(self.chars) + len(self.rare) + 1

    def _rare_moves(self, state: np.ndarray, code: np.ndarray, roots: np.ndarray) -> np.ndarray:
        """Moves under rare characters; the arguments are broadcast against each other."""
        def find(states):
            if not len(self.keys):
                return np.zeros(states.shape, bool), np.zeros(states.shape, np.int32)
            wanted = states.astype(np.int64) * self._width() + code
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            return self.keys[at] == wanted, self.targets[at]

        roots = np.broadcast_to(roots, state.shape)
        known, to = find(state)
        begins, first = find(roots)
        # at the start, and after a character that no phrase has, any character begins one
        again = np.where(state == roots, to | _RESTART, to)
        return np.where(known, again, np.where(begins, first, roots) | _RESTART)

    def _move(self, table: np.ndarray, state: np.ndarray, code: np.ndarray, roots: np.ndarray) -> np.ndarray:
        """Next states, with the restart bit where the character begins a phrase."""
        width = len(self.chars) + 1
        move = table[state * width + np.where(code < width, code, 0)]
        rare = np.flatnonzero(code >= width)
        if len(rare):
            own = roots if roots.shape[-1] == 1 else roots[..., rare]
            move[..., rare] = self._rare_moves(state[..., rare], code[rare], own)
        return move

    def table(self) -> np.ndarray:
        """Flat (state, code) table; the restart bit marks that the character begins a phrase."""
        width = len(self.chars) + 1
        flat = np.zeros((self.states, width), np.int32)
        state, code, to = self.moves.T
        ends = [*self.roots, self.states][1:]
        for root, end in zip(self.roots, ends, strict=True):
            again = np.full(width, root, np.int32)
            own = state == root
            again[code[own]] = to[own]
            flat[root:end] = again | _RESTART
        flat[state, code] = np.where(np.isin(state, self.roots), to | _RESTART, to)
        return flat.ravel()

    def codes(self, text: str) -> np.ndarray:
        points = np.frombuffer(plain(text).encode("utf-32-le", "surrogatepass"), np.uint32)
        out = np.zeros(len(points), np.int32)
        for chars, base in ((self.chars, 1), (self.rare, len(self.chars) + 1)):
            if chars:
                known = np.array([ord(c) for c in chars], np.uint32)
                at = np.searchsorted(known, points)
                at[at == len(known)] = 0
                out = np.where(known[at] == points, at + base, out).astype(np.int32)
        return out

    def phrases(self, table: np.ndarray, codes: list[np.ndarray]) -> np.ndarray:
        """(texts, languages): phrases of each text against each language.

        All segments are parsed side by side as if each began a text.  What a
        phrase over a cut changes is mended afterwards: the parse of the segment
        before goes on into a segment until both begin a phrase at one place,
        from where they are the same.
        """
        roots = np.array(self.roots, np.int32)
        lengths = np.array([len(c) for c in codes], np.int64)
        flat = np.concatenate(codes) if codes else np.empty(0, np.int32)
        first = np.r_[0, np.cumsum(lengths)[:-1]]
        segments = -(-lengths // SEGMENT)
        owner = np.repeat(np.arange(len(codes)), segments)
        within = np.arange(len(owner)) - np.repeat(np.r_[0, np.cumsum(segments)[:-1]], segments)
        starts = first[owner] + within * SEGMENT
        sizes = np.minimum(SEGMENT, lengths[owner] - within * SEGMENT)
        count = np.zeros((len(owner), len(roots)), np.int64)
        final = np.zeros((len(owner), len(roots)), np.int32)
        marks = np.zeros((len(owner), len(roots), -(-SEGMENT // 8)), np.uint8)
        order = np.argsort(-sizes, kind="stable")
        wide = max(1, min(LANES, CELLS // (SEGMENT * max(1, len(roots)))))
        for at in range(0, len(order), wide):
            lanes = order[at : at + wide]
            begin, size = starts[lanes], sizes[lanes]
            state = np.repeat(roots[:, None], len(lanes), 1)
            ends = np.zeros((int(size[0]), *state.shape), bool)
            for step in range(int(size[0])):
                n = int(np.searchsorted(-size, -step))  # lanes longer than `step`
                move = self._move(table, state[:, :n], flat[begin[:n] + step], roots[:, None])
                ends[step, :, :n] = move >> 30
                state[:, :n] = move & (_RESTART - 1)
            count[lanes] = ends.sum(0).T
            final[lanes] = state.T
            packed = np.packbits(ends.transpose(2, 1, 0), axis=2)
            marks[lanes, :, : packed.shape[2]] = packed
        self._mend(table, flat, starts, sizes, within, count, final, marks)
        total = np.zeros((len(codes), len(roots)), np.int64)
        np.add.at(total, owner, count)
        return total

    def _mend(self, table, flat, starts, sizes, within, count, final, marks) -> None:
        """Bring counts and final states of segments to those of the whole text."""
        roots, alone = np.array(self.roots, np.int32), final.copy()
        seg, lang = np.nonzero(np.repeat((within > 0)[:, None], len(roots), 1))
        while len(seg):
            state, own = final[seg - 1, lang], roots[lang]
            before = final[seg, lang].copy()
            live, seen, passed = np.arange(len(seg)), np.zeros(len(seg), np.int64), np.zeros(len(seg), np.int64)
            step = 0
            while len(live):
                over = step >= sizes[seg[live]]
                if over.any():  # never together: this parse is the one of the segment
                    gone = live[over]
                    final[seg[gone], lang[gone]] = state[gone]
                    count[seg[gone], lang[gone]] = seen[gone]
                    live = live[~over]
                    if not len(live):
                        break
                s, k = seg[live], lang[live]
                move = self._move(table, state[live], flat[starts[s] + step], own[live])
                mine = (move >> 30).astype(bool)
                theirs = (marks[s, k, step >> 3] >> (7 - (step & 7)) & 1).astype(bool)
                state[live] = move & (_RESTART - 1)
                seen[live] += mine
                passed[live] += theirs
                together = live[mine & theirs]
                count[seg[together], lang[together]] += seen[together] - passed[together]
                final[seg[together], lang[together]] = alone[seg[together], lang[together]]
                live = live[~(mine & theirs)]
                step += 1
            # a segment that now ends in another state changes the one after it
            changed = final[seg, lang] != before
            seg, lang = seg[changed] + 1, lang[changed]
            inside = seg < len(within)
            inside[inside] = within[seg[inside]] > 0
            seg, lang = seg[inside], lang[inside]
            # the marks of these are still those of a parse from their start
            count[seg, lang] = np.bitwise_count(marks[seg, lang]).sum(1)


def sample(docs: DataFrame, text: str, label: str, doc_id: str) -> dict[str, str]:
    """The bounded labelled sample: rows in hash order of their id, per language."""
    order = W.partitionBy("label").orderBy(F.md5(F.coalesce("id", F.lit(""))), F.xxhash64("text"))
    labelled = docs.select(
        F.col(label).alias("label"), F.col(doc_id).cast("string").alias("id"),
        F.substring(text, 1, SAMPLE_CHARS).alias("text"),
    ).filter("label is not null and length(text) > 0")
    names = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
    names = names.orderBy(F.desc("rows"), "label").limit(LANGUAGES).select("label")
    rows = (
        labelled.join(F.broadcast(names), "label")  # LANGUAGES rows at most
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= SAMPLE_ROWS)
        .collect()
    )
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["label"], r["n"])):
        out.setdefault(r["label"], []).append(r["text"])
    return {name: "\n".join(texts) for name, texts in out.items()}


def _kernel(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parser = shared_value(shared)
        table = parser.table()
        weight = np.log2(parser.sizes) if parser.languages else np.empty(0)
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            worded = np.array([any(map(str.isalpha, t)) for t in texts], bool)
            names = np.full(len(texts), "und", object)
            scores = np.zeros(len(texts))
            at = np.flatnonzero(worded)
            if len(at) and parser.languages:
                cost = parser.phrases(table, [parser.codes(texts[i]) for i in at]) * weight
                best = cost.argmin(1)
                names[at] = [parser.languages[b] for b in best]
                ranked = np.sort(cost, 1)
                second = ranked[:, 1] if cost.shape[1] > 1 else ranked[:, 0] * math.inf
                scores[at] = 1 - ranked[:, 0] / (ranked[:, 0] + second)
            yield batch[["doc_id"]].assign(lang_pred=names, score=scores)

    return run


def identify(
    docs: DataFrame, train: DataFrame, text: str = "text", label: str = "lang", doc_id: str = "doc_id",
) -> DataFrame:
    """One row per document: doc_id, lang_pred, score (0.5 undecided to 1).

    `train` is the labelled table; a bounded sample of it is learned.  A text
    without a letter, empty or NULL is `und` with score 0, and so is every text
    when nothing was learned.  Equal costs go to the first language by name.
    Whole texts are parsed; other columns are ignored.
    """
    parser = CrossParser(sample(train, text, label, doc_id))
    shared = share(docs.sparkSession, parser)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(_kernel(shared), "doc_id long, lang_pred string, score double")
