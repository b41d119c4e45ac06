"""Secret scans: fixed patterns, and a character convolutional network beside them.

The patterns find assignments, access keys and hex runs.  Every other token that
could be a secret is a candidate too; the network reads each candidate with the
text around it.  It is trained on labelled findings: those of all documents,
labelled by the patterns and the formats of known keys, and renderings of
well-known secret and look-alike formats in contexts of the documents.
Candidates that nothing vouches for but that look random have no label and are
left out.  Spark deals the findings to shards of bounded size; in a round every
shard goes over its findings once from the common weights, and the weights of all
are averaged.  Logits are calibrated on all findings that were not trained on, and the
threshold is the highest that still keeps the wanted share of the secrets among
candidates.  Pattern spans always stay; candidates at or above the threshold are
added as `token` spans.
"""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice, takewhile

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.selection import values_at
from ..session import materialize
from .common import partitions, share, shared_value

ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
KINDS = ("assign", "access", "hex", "token")

#: Findings that one shard trains on, about; there are as many shards as it takes.
SHARD = 2_000
#: Times that every finding is trained on.
EPOCHS = 12
#: Beginnings of texts that formats are rendered in.
CONTEXTS = 500
#: Renderings of each format below, for each shard.
RENDERED = 60
#: Share of the secrets of a kind that its threshold must keep.
RECALL = 0.98
SEED = 11

#: Characters of context on each side, and of a candidate, in one window.
SIDE, CORE = 16, 48
WIDTH = 2 * SIDE + CORE
EMBED, FILTERS, REACH = 8, 24, 5

_ALNUM = string.ascii_letters + string.digits
#: (text before, prefix of the token, alphabet, least and most characters, text
#: after, 1 for a secret).  Public formats of keys, and tokens that look like them;
#: no runs of hex digits, which the patterns take before the network sees them.
FORMATS = (
    ("", "ghp_", _ALNUM, 36, 36, "", 1),
    ("", "glpat-", _ALNUM + "_-", 20, 20, "", 1),
    ("", "xoxb-", string.digits + "-" + _ALNUM, 40, 56, "", 1),
    ("", "sk_live_", _ALNUM, 24, 32, "", 1),
    ("", "AIza", _ALNUM + "_-", 35, 35, "", 1),
    ("", "npm_", _ALNUM, 36, 36, "", 1),
    ("", "eyJ", _ALNUM + "_-.", 80, 160, "", 1),
    ("Authorization: Bearer ", "", _ALNUM + "_-", 32, 48, "", 1),
    ("aws_secret_access_key = ", "", _ALNUM + "+/", 40, 40, "", 1),
    ("client_secret: '", "", _ALNUM + "_-", 24, 40, "'", 1),
    ("private_key=", "", _ALNUM + "+/", 40, 88, "==", 1),
    ("pwd: ", "", _ALNUM, 14, 24, "", 1),
    ("auth ", "", _ALNUM + "+/=", 32, 64, "", 1),
    ("AccountKey=", "", _ALNUM + "+/", 86, 86, "==", 1),
    ("key ", "", string.ascii_lowercase + string.digits, 32, 64, "", 1),
    ("with ", "pat_", string.ascii_lowercase + string.digits, 32, 48, "", 1),
    ("card ", "4", string.digits, 15, 15, "", 0),
    ("tel. ", "+", string.digits, 11, 13, "", 0),
    ("at ", "20", "0123456789-", 10, 12, "", 0),
    ("see www.", "", string.ascii_lowercase, 6, 14, ".example.com/p1", 0),
    ("file ", "/usr/lib/", string.ascii_lowercase + "/", 8, 24, "-1.2.so", 0),
    ("user", "@", string.ascii_lowercase, 5, 12, "7.example.org", 0),
    ("version ", "v", "0123456789.", 11, 16, "", 0),
    ("host ", "10.", "0123456789.", 10, 12, "", 0),
    ("ISBN ", "978-", "0123456789-", 11, 13, "", 0),
    ("id ", "", "0123456789", 12, 18, "", 0),
    ("read ", "", string.ascii_lowercase + "-", 16, 32, "-in-2024", 0),
    ("see https:", "//www.", string.ascii_lowercase + "./", 12, 40, "-2.html", 0),
    ("uuid ", "", "0123456789abcdef-", 32, 36, "", 0),
    ("chapter", "_", string.ascii_lowercase + "_", 10, 20, "_2", 0),
)


_PARTS = [
    (re.escape(before.rstrip()) + r"\s*" if before else r"(?<![A-Za-z0-9])")
    + re.escape(prefix) + f"[{re.escape(alphabet)}]{{{least},}}"
    for before, prefix, alphabet, least, _, _, label in FORMATS if label
]
KNOWN = re.compile("|".join(f"(?:{p})" for p in _PARTS))
#: The longest text before a key, with some white space.
BEFORE = max(len(f[0]) for f in FORMATS) + 4


def known_key(text: str, start: int, end: int) -> bool:
    """Whether a candidate holds a key of a known format."""
    return any(m.end() > start for m in KNOWN.finditer(text, max(0, start - BEFORE), end))


def looks_random(word: str) -> bool:
    """A run of 16 letters and digits with a digit and both cases."""
    return any(
        re.search("[0-9]", run) and re.search("[a-z]", run) and re.search("[A-Z]", run)
        for run in re.findall("[A-Za-z0-9]{16,}", word)
    )


def label_of(text: str, start: int, kind: int, end: int) -> int | None:
    """1 for a secret, 0 for none, None where it is not known."""
    word = text[start:end]
    if kind < 2:
        return 1
    if kind == 2:
        return int(not word.isdigit())  # a hex run of digits alone is a number
    if known_key(text, start, end):
        return 1
    return None if looks_random(word) else 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the patterns, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def token_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates beside the patterns: long runs with a digit and a letter or sign,
    or of 20 characters and more in mixed case, that no pattern span touches."""
    found, k = [], 0
    for m in TOKEN.finditer(text):
        word = m[0]
        if not any(map(word.__contains__, string.digits)) and (
            len(word) < 20 or word.isupper() or word[1:].islower() or word.islower()
        ):
            continue
        while k < len(base) and base[k][2] <= m.start():
            k += 1
        near = takewhile(lambda b: b[0] < m.end(), islice(base, k, None))
        if not any(b[2] > m.start() for b in near):
            found.append((m.start(), 3, m.end()))
    return found


def windows(text: str, start: int, end: int) -> list[str]:
    """Windows of fixed width over a candidate: its context, NUL outside the text.

    A character \\x01 stands on both sides of the candidate.  A long candidate
    has several windows, so all of it is read.
    """
    left = text[max(0, start - SIDE + 1) : start].rjust(SIDE - 1, "\0") + "\x01"
    right = "\x01" + text[end : end + SIDE - 1].ljust(SIDE - 1, "\0")
    core = text[start:end]
    step = CORE // 2
    starts = range(0, max(1, len(core) - CORE + step), step) if len(core) > CORE else (0,)
    return [left + core[i : i + CORE].ljust(CORE, "\0") + right for i in starts]


def encode(lines: list[str]) -> np.ndarray:
    """Codes 0 to 127, 127 for every character beyond ASCII."""
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.minimum(points, 127).astype(np.int64).reshape(len(lines), WIDTH)


def class_weights(labels: np.ndarray, positive: int, n: int) -> np.ndarray:
    """Weights under which `positive` secrets among n findings count as much as the rest."""
    return np.where(labels > 0, n / max(1, 2 * positive), n / max(1, 2 * (n - positive)))


class CharNet:
    """Embedding, one convolution, maximum and mean pooling, one unit."""

    def __init__(self, seed: int = SEED):
        r = np.random.default_rng(seed)
        self.p = {
            "e": r.normal(0, 0.5, (128, EMBED)),
            "w": r.normal(0, 0.2, (REACH * EMBED, FILTERS)),
            "b": np.zeros(FILTERS),
            "u": r.normal(0, 0.2, 2 * FILTERS),
            "c": np.zeros(1),
        }

    def _forward(self, codes: np.ndarray):
        x = self.p["e"][codes]
        view = np.lib.stride_tricks.sliding_window_view(x, REACH, 1).transpose(0, 1, 3, 2)
        cols = view.reshape(len(codes), WIDTH - REACH + 1, REACH * EMBED)
        h = np.maximum(cols @ self.p["w"] + self.p["b"], 0)
        pooled = np.concatenate([h.max(1), h.mean(1)], 1)
        return cols, h, pooled, pooled @ self.p["u"] + self.p["c"][0]

    def logits(self, codes: np.ndarray) -> np.ndarray:
        parts = [self._forward(codes[i : i + 512])[3] for i in range(0, len(codes), 512)]
        return np.concatenate(parts) if parts else np.empty(0)

    def fit(self, codes: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS) -> None:
        r, state = np.random.default_rng(SEED), self.moments()
        weight = class_weights(labels, int(labels.sum()), len(labels))
        step = 0
        for _ in range(epochs):
            step = self.epoch(codes, labels, weight, state, step, r)

    def moments(self) -> dict[str, list[np.ndarray]]:
        return {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.p.items()}

    def epoch(self, codes, labels, weight, state, step: int, r, rate: float = 3e-3) -> int:
        """All findings once, in batches; the number of the last step."""
        order = r.permutation(len(labels))
        for at in range(0, len(order), 64):
            i = order[at : at + 64]
            step += 1
            for k, g in self._gradients(codes[i], labels[i], weight[i]).items():
                a, b = state[k]
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                self.p[k] -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
        return step

    def _gradients(self, codes, labels, weight) -> dict[str, np.ndarray]:
        cols, h, pooled, z = self._forward(codes)
        n, t = len(codes), h.shape[1]
        dz = weight * (1 / (1 + np.exp(-z)) - labels) / n
        dp = dz[:, None] * self.p["u"]
        dh = np.repeat(dp[:, None, FILTERS:] / t, t, 1)
        top = h.argmax(1)
        np.add.at(dh, (np.arange(n)[:, None], top, np.arange(FILTERS)[None, :]), dp[:, :FILTERS])
        dh *= h > 0
        dcols = (dh @ self.p["w"].T).reshape(n, t, REACH, EMBED)
        de = np.zeros_like(self.p["e"])
        for k in range(REACH):
            np.add.at(de, codes[:, k : k + t], dcols[:, :, k])
        return {
            "e": de, "w": np.tensordot(cols, dh, ((0, 1), (0, 1))), "b": dh.sum((0, 1)),
            "u": pooled.T @ dz, "c": np.array([dz.sum()]),
        }


@dataclass
class Detector:
    net: CharNet
    slope: float
    offset: float
    thresholds: dict[str, float]

    def probabilities(self, found: list[list[str]]) -> np.ndarray:
        """Calibrated probability of each candidate, the highest of its windows."""
        counts = np.array([len(w) for w in found], np.int64)
        if not len(counts):
            return np.empty(0)
        z = self.net.logits(encode([w for ws in found for w in ws]))
        z = np.maximum.reduceat(z, np.r_[0, np.cumsum(counts)[:-1]])
        return 1 / (1 + np.exp(-(self.slope * z + self.offset)))


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit of labels on logits, by Newton steps."""
    x = np.stack([z, np.ones_like(z)], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (p - y) + 1e-2 * (beta - [1.0, 0.0])
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        beta = beta - np.linalg.solve(hess, grad)
    return max(float(beta[0]), 1e-3), float(beta[1])


def _held(window: str) -> bool:
    """Whether a finding only calibrates: three in ten, by hash."""
    return zlib.crc32(window.encode("utf-8", "surrogatepass")) % 10 < 3


@dataclass
class Findings:
    """Written findings of a table (kind, window, label, held) and rendered ones."""

    own: DataFrame
    made: list[tuple[str, str, int]]


def _pack(values: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([v.ravel() for v in values])


def _unpack(net: CharNet, flat: np.ndarray) -> dict[str, list[np.ndarray]]:
    """Sets the weights of a net from `_pack`, and gives its two moments."""
    parts, at = [], 0
    for _ in range(3):
        part = {}
        for k, v in net.p.items():
            part[k] = flat[at : at + v.size].reshape(v.shape).copy()
            at += v.size
        parts.append(part)
    net.p = parts[0]
    return {k: [parts[1][k], parts[2][k]] for k in net.p}


#: Weights are averaged as whole multiples of 2^-36, so no order of the sum matters;
#: second moments are small, so they travel as roots.
_UNIT = float(1 << 36)


def _epoch_kernel(shared):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        flat, made, positive, n, turn, step = shared_value(shared)
        net = CharNet()
        state = _unpack(net, flat)
        rows = rows.sort_values(["window", "kind", "label"])
        codes = encode([*rows["window"], *(w for _, w, _ in made)])
        labels = np.array([*rows["label"], *(y for _, _, y in made)], float)
        r = np.random.default_rng([SEED, turn, int(key[0])])
        last = net.epoch(codes, labels, class_weights(labels, positive, n), state, step, r)
        out = _pack([*net.p.values(), *(a for a, _ in state.values()), *(np.sqrt(b) for _, b in state.values())])
        units = np.rint(out * _UNIT).astype(np.int64)
        return pd.DataFrame({"i": np.arange(len(out)), "units": units, "step": last})

    return run


def _logit_kernel(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net = shared_value(shared)
        for batch in batches:
            z = net.logits(encode(list(batch["window"])))
            yield pd.DataFrame({"kind": batch["kind"], "label": batch["label"], "z": z})

    return run


def _platt_rows(rows: DataFrame) -> tuple[float, float]:
    """`_platt` with the sums taken by Spark; decimals, so no order of the sum matters."""
    beta = np.array([1.0, 0.0])
    for _ in range(25):
        margin = F.least(F.greatest(F.col("z") * float(beta[0]) + float(beta[1]), F.lit(-30.0)), F.lit(30.0))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
        z, off, flat = F.col("z"), p - F.col("label"), p * (F.lit(1.0) - p)
        sums = [F.coalesce(F.sum(v.cast("decimal(28,15)")), F.lit(0)).cast("double") for v in (
            z * off, off, z * z * flat, z * flat, flat)]
        g1, g0, h11, h10, h00 = rows.agg(*[v.alias(f"s{i}") for i, v in enumerate(sums)]).first()
        grad = np.array([g1, g0]) + 1e-2 * (beta - [1.0, 0.0])
        move = np.linalg.solve(np.array([[h11, h10], [h10, h00]]) + 1e-2 * np.eye(2), grad)
        beta = beta - move
        if np.abs(move).max() < 1e-9:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def _train_rows(findings: Findings, recall: float) -> Detector:
    """`train` on a table.  Every shard has the rendered findings beside its own, and
    they calibrate as often as there are shards."""
    spark = findings.own.sparkSession
    learned = findings.own.filter("not held")
    n, positive = learned.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    shards = max(1, -(-n // SHARD))
    made = [f for f in findings.made if not _held(f[1])]
    # a shard that gets no finding of the table has no task
    keyed = learned.withColumn("shard", F.pmod(F.xxhash64("window"), F.lit(shards))).repartition(
        min(shards, partitions(spark)), "shard"  # small rows, but long work: not to be coalesced
    )
    total, secrets = n + shards * len(made), positive + shards * sum(y for _, _, y in made)
    net = CharNet()
    zeros = [np.zeros_like(v) for v in net.p.values()]
    flat, step = _pack([*net.p.values(), *zeros, *zeros]), 0
    if n:
        size = flat.size // 3
        for turn in range(EPOCHS):
            shared = share(spark, (flat, made, secrets, total, turn, step))
            found = (
                keyed.groupBy("shard").applyInPandas(_epoch_kernel(shared), "i int, units long, step int")
                .groupBy("i").agg(
                    F.sum("units").alias("units"), F.count(F.lit(1)).alias("n"), F.max("step").alias("step")
                ).orderBy("i").collect()  # one row a weight
            )
            flat = np.array([r["units"] / r["n"] / _UNIT for r in found])
            flat[2 * size :] **= 2
            step = found[0]["step"]
            shared.unpersist()
        _unpack(net, flat)
    else:
        net.fit(encode([w for _, w, _ in made]), np.array([y for _, _, y in made], float))
    rest = [f for f in findings.made if _held(f[1])]
    again = spark.createDataFrame(rest, "kind string, window string, label int").withColumn(
        "_", F.explode(F.sequence(F.lit(1), F.lit(shards)))
    )
    shared = share(spark, net)
    columns = ("kind", "window", "label")
    scored = materialize(
        findings.own.filter("held").select(*columns).unionByName(again.select(*columns))
        .mapInPandas(_logit_kernel(shared), "kind string, label int, z double")
    )
    slope, offset = _platt_rows(scored)
    # The network only adds spans of the last kind; a higher logit is a higher probability.
    own = scored.filter("label > 0 and kind = 'token'")
    n = own.count()
    if n < 20:
        own = scored.filter("label > 0")
        n = own.count()
    threshold = 0.5
    if n:
        rank = int((1 - recall) * n)
        threshold = float(1 / (1 + np.exp(-(slope * np.float64(values_at(own, "z", [rank])[rank]) + offset))))
    return Detector(net, slope, offset, {"token": threshold})


def train(findings: Findings | list[tuple[str, str, int]], recall: float = RECALL) -> Detector:
    """findings: those of a table, or a list of (kind, window, label).

    Three in ten, by hash, only calibrate.
    """
    if isinstance(findings, Findings):
        return _train_rows(findings, recall)
    net = CharNet()
    codes = encode([w for _, w, _ in findings])
    labels = np.array([y for _, _, y in findings], float)
    held = np.array([_held(w) for _, w, _ in findings])
    net.fit(codes[~held], labels[~held])
    z, y = net.logits(codes[held]), labels[held]
    slope, offset = _platt(z, y)
    p = 1 / (1 + np.exp(-(slope * z + offset)))
    kinds = np.array([k for k, _, _ in findings])[held]
    # The network only adds spans of the last kind.
    own = np.sort(p[(y > 0) & (kinds == "token")])
    if len(own) < 20:
        own = np.sort(p[y > 0])
    thresholds = {"token": float(own[int((1 - recall) * len(own))]) if len(own) else 0.5}
    return Detector(net, slope, offset, thresholds)


def rendered(contexts: list[str], seed: int = SEED) -> list[tuple[str, str, int]]:
    """Labelled findings of the formats, in contexts of the corpus."""
    r = np.random.default_rng(seed)
    out = []
    for before, prefix, alphabet, least, most, after, label in FORMATS:
        for _ in range(RENDERED):
            body = "".join(r.choice(list(alphabet), int(r.integers(least, most + 1))))
            word = prefix + body + after.rstrip("'")
            context = contexts[int(r.integers(len(contexts)))] if contexts else " " * (2 * SIDE)
            lead = context[:SIDE] + (before if r.random() < 0.8 or not label else "")
            text = lead + word + after[len(after.rstrip("'")) :] + " " + context[SIDE:]
            out.extend(("token", w, label) for w in windows(text, len(lead), len(lead) + len(word)))
    return out


def _findings_kernel():
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                text = text or ""
                base = base_spans(text)
                for start, kind, end in base + token_spans(text, base):
                    label = label_of(text, start, kind, end)
                    for w in windows(text, start, end) if label is not None else ():
                        rows.append((KINDS[kind], w, label, _held(w)))
            yield pd.DataFrame(rows, columns=["kind", "window", "label", "held"])

    return run


def labelled_findings(docs: DataFrame, text: str, doc_id: str) -> Findings:
    """The different findings of all documents, written once, and renderings in their contexts."""
    rows = docs.select(F.col(text).alias("text"))
    found = rows.mapInPandas(_findings_kernel(), "kind string, window string, label int, held boolean")
    starts = rows.select(F.substring("text", 1, 2 * SIDE).alias("t")).filter(F.length("t") == 2 * SIDE)
    contexts = [r["t"] for r in starts.distinct().orderBy(F.md5("t"), "t").limit(CONTEXTS).collect()]
    return Findings(materialize(found.distinct()), rendered(contexts))


def _scan_kernel(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detector = shared_value(shared)
        limit = detector.thresholds["token"]
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            base = [base_spans(t) for t in texts]
            owner, spans, seen = [], [], []
            for i, text in enumerate(texts):
                for span in token_spans(text, base[i]):
                    owner.append(i)
                    spans.append(span)
                    seen.append(windows(text, span[0], span[2]))
            added: dict[int, list] = {}
            for i, span, p in zip(owner, spans, detector.probabilities(seen), strict=True):
                if p >= limit:
                    added.setdefault(i, []).append(span)
            rows = []
            for i, own in enumerate(base):
                kinds = [k for _, k, _ in own]
                name = lambda s: f"{KINDS[s[1]]}:{s[0]}:{s[2]}"
                digest = hashlib.sha256(",".join(map(name, own)).encode()).hexdigest()
                every = ",".join(map(name, sorted(own + added.get(i, []))))
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2), digest, every))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return run


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are kind:start:end in code points, end exclusive, by start and then
    kind.  A NULL or empty text has none.  Repeated rows stay; other columns are
    ignored; an empty table trains on the formats alone and gives no rows.
    """
    detector = train(labelled_findings(docs, text, doc_id))
    shared = share(docs.sparkSession, detector)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return rows.mapInPandas(_scan_kernel(shared), schema)
