"""Secrets in texts: fixed patterns, and a character network that judges wider candidates.

Three patterns (assigned values, access key ids, long hexadecimal runs) always count. Beside them, wider patterns name
candidates: values assigned to a larger set of names, passwords inside URLs, private key blocks and long mixed runs of
characters. A convolutional network over the characters of a candidate and of the text around it scores every candidate
and every fixed finding; candidates that reach the threshold of their shape are findings, too.

The network is trained here, on labelled findings of two sources. Some come from the corpus, from every whole document:
its fixed findings are secrets, its other candidates are not. The others are made by a recipe, for every document in
places cut out of it: secrets in the formats of well-known services, and look-alikes that are none (uuids, paths,
versions, names, numbers, placeholders). Two thirds of the findings train the network, the rest calibrates its score to a probability and sets the thresholds:
for each shape one half, or less where only a lower threshold still finds `RECALL` of these secrets.

Every document is searched as a whole. A candidate of any length is read, in overlapping windows; its best one counts.
"""

from __future__ import annotations

import base64
import random
import re
import string
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.arrow import by_batch
from tallyfold.session import stage

RECALL = 0.98
MADE = 2500  # made findings of each label, at least
SEED = 42
RATE = 0.005
PART_WINDOWS = 1 << 14  # windows that one copy of the network is trained on, as long as there are few parts
MOST_PARTS = 512  # copies of the network, of 33 KB, that reach the driver in a round
LOGIT, BINS = 27.0, 256  # bounds of a held-out logit, and steps per unit in which it is counted

BASE = ("assign", "access", "hex")
FOUND = "model"
SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a run is as long as it gets, so shorter ones need not be matched and dropped
_STEMS = ("passw", "secret", "token", "api_key", "apikey")

_KEYED = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|key|auth|bearer|credentials?|signature|connection_?string)["']?"""
    r"""(?:\x20{0,3}(?::=|=>|[:=])\x20{0,3}|(?<=bearer)\x20)["']?([^\s"'<>,;(){}]{6,})""",
    re.IGNORECASE | re.ASCII,
)
_KEYED_STEMS = ("pass", "pwd", "secret", "token", "key", "auth", "bearer", "credential", "signature", "string")
_URL = re.compile(r"://[^\s/:@]{1,256}:([^\s/:@]{3,256})@")
_PEM = re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[^-]|-(?!----))*-----END [A-Z ]{0,40}PRIVATE KEY-----")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=~-])[A-Za-z0-9+/_=~-][A-Za-z0-9+/_=.~-]{15,}")
SHAPES = ("keyed", "url", "pem", "run")

BEFORE, INSIDE, AFTER = 24, 64, 24
_WIDTH = BEFORE + INSIDE + AFTER
_STRIDE = 48


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The findings of the fixed patterns: (kind, start, end), by start, then kind; code points, end exclusive."""
    found = []
    lowered = text.lower()
    if any(stem in lowered for stem in _STEMS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m.group()) >= 20]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], BASE.index(s[0])))


def _mixed(run: str) -> bool:
    """Whether a run is more than a word or a number: two of small letters, capitals behind the first, and digits."""
    has = [any(map(test, part)) for test, part in ((str.islower, run), (str.isupper, run[1:]), (str.isdigit, run))]
    return sum(has) > 1


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Wider findings: (shape, start, end), not overlapping; of two that would, the earlier shape of `SHAPES` stays."""
    lowered = text.lower()
    found = []
    if any(stem in lowered for stem in _KEYED_STEMS):
        found += [("keyed", *m.span(1)) for m in _KEYED.finditer(text)]
    if "://" in text:
        found += [("url", *m.span(1)) for m in _URL.finditer(text)]
    if "PRIVATE KEY-----" in text:
        found += [("pem", *m.span()) for m in _PEM.finditer(text)]
    found += [("run", *m.span()) for m in _RUN.finditer(text) if _mixed(m.group())]
    found.sort(key=lambda s: (SHAPES.index(s[0]), s[1]))
    return _apart(found, [])


def _apart(spans: list[tuple], taken: list[tuple]) -> list[tuple]:
    """The `spans` that overlap neither `taken` nor an earlier one that stays; by start."""
    marks = sorted((s[1], s[2]) for s in taken)
    # Each shape's spans do not overlap among themselves, so a merge per shape is enough.
    kept: list[tuple] = []
    for shape in dict.fromkeys(s[0] for s in spans):
        mine = sorted((s for s in spans if s[0] == shape), key=lambda s: s[1])
        at, fresh = 0, []
        for span in mine:
            while at < len(marks) and marks[at][1] <= span[1]:
                at += 1
            if at == len(marks) or marks[at][0] >= span[2]:
                fresh.append(span)
        kept += fresh
        # Disjoint by construction within `kept`; given marks may overlap each other, so ends are made to rise.
        marks = _rising(marks + [(s[1], s[2]) for s in fresh])
    return sorted(kept, key=lambda s: s[1])


def _rising(marks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(marks):
        if merged and start < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


# Character classes: 0 pads, printable ASCII has a class each, then line ends, other letters and anything else.
_CLASSES = 99


def _class_table() -> np.ndarray:
    table = np.full(0x110000, 98, np.uint8)
    table[32:127] = np.arange(1, 96)
    table[[9, 10, 13]] = 96
    table[0] = 0
    table[0xAA:0x2000] = 97
    return table


_TABLE = _class_table()


def windows(text: str, start: int, end: int) -> list[str]:
    """The texts of fixed length that the network reads for a span: what is before, inside and behind it."""
    before, after = text[max(start - BEFORE, 0) : start].rjust(BEFORE, "\0"), text[end : end + AFTER].ljust(AFTER, "\0")
    places = [start]
    while places[-1] + INSIDE < end:
        places.append(min(places[-1] + _STRIDE, end - INSIDE))
    return [before + text[p : min(p + INSIDE, end)].ljust(INSIDE, "\0") + after for p in places]


def encode(texts: list[str]) -> np.ndarray:
    return _TABLE[np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")].reshape(len(texts), _WIDTH)


class Network:
    """Characters, one convolution, pools before, inside and behind the span, one hidden layer, a logit."""

    CHARS, TAPS, MAPS, HIDDEN = 8, 5, 24, 24

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        pooled = 4 * self.MAPS
        self.weights = {
            "chars": draw(_CLASSES, self.CHARS) * 3,
            "filters": draw(self.TAPS * self.CHARS, self.MAPS),
            "lift": np.zeros(self.MAPS, np.float32),
            "hidden": draw(pooled, self.HIDDEN),
            "hidden_lift": np.zeros(self.HIDDEN, np.float32),
            "out": draw(self.HIDDEN, 1),
            "out_lift": np.zeros(1, np.float32),
        }
        outputs = _WIDTH - self.TAPS + 1
        cuts = (0, BEFORE - 2, BEFORE + INSIDE - 2, outputs)
        self.parts = [slice(a, b) for a, b in zip(cuts, cuts[1:])]

    def forward(self, codes: np.ndarray) -> tuple[np.ndarray, tuple]:
        w = self.weights
        chars = w["chars"][codes]
        taps = np.lib.stride_tricks.sliding_window_view(chars, self.TAPS, axis=1).transpose(0, 1, 3, 2)
        taps = taps.reshape(len(codes), -1, self.TAPS * self.CHARS)
        maps = np.maximum(taps @ w["filters"] + w["lift"], 0)
        tops = [part.start + maps[:, part].argmax(1) for part in self.parts]
        row, column = np.arange(len(codes))[:, None], np.arange(self.MAPS)[None, :]
        used = (codes[:, BEFORE : BEFORE + INSIDE] > 0).astype(np.float32)
        share = used / np.maximum(used.sum(1, keepdims=True), 1)
        mean = (share[:, None, :] @ maps[:, self.parts[1]])[:, 0]
        pooled = np.concatenate([*(maps[row, t, column] for t in tops), mean], axis=1)
        hidden = np.maximum(pooled @ w["hidden"] + w["hidden_lift"], 0)
        return (hidden @ w["out"] + w["out_lift"])[:, 0], (codes, taps, maps, tops, share, pooled, hidden)

    def logits(self, codes: np.ndarray, step: int = 256) -> np.ndarray:
        parts = [self.forward(codes[s : s + step])[0] for s in range(0, len(codes), step)]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy."""
        w = self.weights
        logit, (codes, taps, maps, tops, share, pooled, hidden) = self.forward(codes)
        slope = ((1 / (1 + np.exp(-logit)) - labels) / len(labels)).astype(np.float32)[:, None]
        to_hidden = (slope @ w["out"].T) * (hidden > 0)
        to_pooled = to_hidden @ w["hidden"].T
        to_maps = np.zeros_like(maps)
        row, column = np.arange(len(codes))[:, None], np.arange(self.MAPS)[None, :]
        for i, top in enumerate(tops):
            to_maps[row, top, column] = to_pooled[:, i * self.MAPS : (i + 1) * self.MAPS]
        to_maps[:, self.parts[1]] += share[:, :, None] * to_pooled[:, None, 3 * self.MAPS :]
        to_maps *= maps > 0
        flat = to_maps.reshape(-1, self.MAPS)
        to_taps = (flat @ w["filters"].T).reshape(len(codes), -1, self.TAPS, self.CHARS)
        to_chars = np.zeros((len(codes), _WIDTH, self.CHARS), np.float32)
        for i in range(self.TAPS):
            to_chars[:, i : i + to_taps.shape[1]] += to_taps[:, :, i]
        flat_codes, flat_chars = codes.ravel(), to_chars.reshape(-1, self.CHARS)
        sums = [np.bincount(flat_codes, flat_chars[:, i], minlength=_CLASSES) for i in range(self.CHARS)]
        chars = np.stack(sums, 1).astype(np.float32)
        return {
            "chars": chars,
            "filters": taps.reshape(-1, self.TAPS * self.CHARS).T @ flat,
            "lift": flat.sum(0),
            "hidden": pooled.T @ to_hidden,
            "hidden_lift": to_hidden.sum(0),
            "out": hidden.T @ slope,
            "out_lift": slope.sum(0),
        }

    def train(self, codes: np.ndarray, labels: np.ndarray, rounds: int = 6, batch: int = 64, rate: float = RATE, until: float = 0.0) -> None:
        """Adam over shuffled batches, with a rate that falls from `rate` to `until`."""
        rng = np.random.default_rng(SEED)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        steps = max(rounds * -(-len(codes) // batch), 1)
        done = 0
        for _ in range(rounds):
            order = rng.permutation(len(codes))
            for s in range(0, len(codes), batch):
                at = order[s : s + batch]
                done += 1
                for name, slope in self.gradients(codes[at], labels[at]).items():
                    first[name] += 0.1 * (slope - first[name])
                    second[name] += 0.01 * (slope * slope - second[name])
                    step = first[name] / (1 - 0.9**done) / (np.sqrt(second[name] / (1 - 0.99**done)) + 1e-8)
                    self.weights[name] -= np.float32(rate + (until - rate) * done / (steps + 1)) * step.astype(np.float32)


@dataclass
class Model:
    """A network, the calibration of its logit and a threshold for each shape; some 30 KB, whatever the corpus."""

    network: Network
    slope: float
    shift: float
    thresholds: dict[str, float]

    def logits(self, found: list[list[str]]) -> np.ndarray:
        """Of each span, given by its windows: that of its best window."""
        if not found:
            return np.zeros(0)
        logits = self.network.logits(encode([w for spans in found for w in spans]))
        return np.maximum.reduceat(logits, np.cumsum([0] + [len(spans) for spans in found[:-1]])).astype(np.float64)

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * logits + self.shift)))

    def scores(self, found: list[list[str]]) -> np.ndarray:
        """Probability of each span, given by its windows."""
        return self.probability(self.logits(found))


# Names that code gives to secrets, and to other things.
SECRET_NAMES = ("password", "passwd", "pwd", "secret", "token", "api_key", "auth", "bearer", "access_key", "client_secret",
                "private_key", "credentials", "signature", "passphrase", "connection_string")
PLAIN_NAMES = ("id", "path", "version", "url", "name", "file", "date", "checksum_file", "key", "token", "primary_key",
               "author", "password", "sort_key", "uuid", "branch", "class", "auth")
PREFIXES = ("ghp_", "gho_", "github_pat_", "glpat-", "sk_live_", "sk_test_", "rk_live_", "xoxb-", "xoxp-", "AIza", "SG.",
            "npm_", "pypi-", "dop_v1_", "shpat_", "ya29.", "hf_", "EAAC", "AKIA", "ASIA", "key-", "sk-")
PLACEHOLDERS = ("your_password_here", "<your-token>", "changeme_please", "xxxxxxxxxxxxxxxx", "${SECRET_TOKEN}", "process.env.TOKEN",
                "os.environ_get", "null_or_empty", "********", "REPLACE_ME_LATER", "example_api_key", "required", "optional",
                "undefined", "getpass.getpass", "config.password", "string_value")
WORDS = ("user", "order", "invoice", "report", "value", "index", "table", "handler", "request", "service", "client", "session",
         "manager", "config", "update", "default", "module", "parser", "widget", "status", "number", "image", "render")


def _word(rng: random.Random) -> str:
    """A listed word or one made of syllables."""
    if rng.random() < 0.5:
        return rng.choice(WORDS)
    syllable = lambda: rng.choice(("", *"bcdfghklmnprstvw", "st", "tr", "ch")) + rng.choice("aeiouy") + rng.choice(("", *"nrstlm", "ck", "ng"))
    return "".join(syllable() for _ in range(rng.randint(1, 3)))


def _password(rng: random.Random) -> str:
    """What a person makes up: a word, perhaps with letters swapped, digits and signs."""
    word = rng.choice((rng.choice(WORDS), "".join(rng.choices(string.ascii_lowercase, k=rng.randint(3, 8)))))
    word = rng.choice((word, word.title(), word.translate(str.maketrans("aeiost", "@31057"))))
    parts = [word, "".join(rng.choices(string.digits, k=rng.randint(1, 4)))]
    parts.append("".join(rng.choices("!#$%&*+?^_", k=rng.randint(0, 3))))
    parts.append("".join(rng.choices(string.ascii_letters + string.digits, k=rng.randint(0, 6))))
    rng.shuffle(parts)
    return "".join(parts).ljust(6, "7")


def _secret(rng: random.Random) -> tuple[str, str, str]:
    """(shape, words around it up to the secret, the secret)."""
    some = lambda letters, n: "".join(rng.choices(letters, k=n))
    letters, hexes = string.ascii_letters + string.digits, "0123456789abcdef"
    kind = rng.randrange(8)
    if kind == 0:
        secret = rng.choice(PREFIXES) + some(letters + "_-", rng.randint(18, 60))
    elif kind == 1:
        secret = some(rng.choice((hexes, hexes.upper())), rng.choice((24, 32, 40, 64)))
    elif kind == 2:
        secret = some(letters, rng.randint(20, 64))
    elif kind == 3:
        secret = base64.b64encode(rng.randbytes(rng.randint(16, 60))).decode()
    elif kind == 4:
        part = lambda n: base64.urlsafe_b64encode(rng.randbytes(n)).decode().rstrip("=")
        secret = f"eyJ{part(rng.randint(15, 30))}.eyJ{part(rng.randint(20, 60))}.{part(32)}"
    elif kind == 5:
        secret = _password(rng)
    elif kind == 6:
        body = base64.b64encode(rng.randbytes(rng.randint(60, 200))).decode()
        name = rng.choice(("RSA ", "EC ", "OPENSSH ", ""))
        lines = "\n".join(body[i : i + 64] for i in range(0, len(body), 64))
        return "pem", "", f"-----BEGIN {name}PRIVATE KEY-----\n{lines}\n-----END {name}PRIVATE KEY-----"
    else:
        secret = rng.choice((_password(rng).replace("/", "_"), some(letters + "!_-", rng.randint(8, 20))))
        return "url", f"{rng.choice(('postgres', 'https', 'amqp', 'mongodb'))}://{rng.choice(WORDS)}:", secret
    if kind == 5 or rng.random() < 0.6:
        name = rng.choice(("", rng.choice(WORDS) + "_")) + rng.choice(SECRET_NAMES)
        name = rng.choice((name, name.upper(), name.title()))
        return "keyed", name + rng.choice(("=", ": ", " = ", '": "', "='", ':"')), secret
    return "run", rng.choice(("", " ", "use ", "got ", '"', "is ")), secret


def _look_alike(rng: random.Random) -> tuple[str, str, str]:
    some = lambda letters, n: "".join(rng.choices(letters, k=n))
    hexes = "0123456789abcdef"
    words = [_word(rng) for _ in range(rng.randint(2, 5))]
    kind = rng.randrange(11)
    if kind == 0:
        value = "-".join(some(hexes, n) for n in (8, 4, 4, 4, 12))
    elif kind == 1:
        value = "/".join(words) + rng.choice(("", ".py", ".html", f"/v{rng.randint(1, 9)}", f"_{rng.randint(1, 2050)}.csv"))
    elif kind == 2:
        value = "_".join(words) + str(rng.randint(0, 99))
    elif kind == 3:
        value = rng.choice((words[0], words[0].title())) + "".join(w.title() for w in words[1:])
        value += rng.choice(("", "Impl", "Impl2", "V2", "Test", "3", "Factory"))
    elif kind == 4:
        value = f"20{rng.randint(10, 29)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}T{rng.randint(10, 23)}-{rng.randint(10, 59)}-{rng.randint(10, 59)}Z"
    elif kind == 5:
        value = f"{words[0]}-{rng.randint(0, 20)}.{rng.randint(0, 20)}.{rng.randint(0, 99)}-{rng.choice(('beta', 'linux-x86_64', 'py3-none-any', 'SNAPSHOT'))}"
    elif kind == 6:
        value = f"mail{rng.randint(1, 99)}.{words[0]}.{words[1]}.example.com"
    elif kind == 7:
        value = rng.choice(PLACEHOLDERS)
    elif kind == 8:
        value = f"{some(string.digits, 4)}-{some(string.digits, 4)}-{some(string.digits, 4)}-{rng.choice('ABX')}{some(string.digits, 4)}"
    elif kind == 9:
        value = rng.choice("=-_~") * rng.randint(16, 40) + rng.choice(("", "a1", words[0] + "1"))
    else:
        value = rng.choice(words) + "." + rng.choice(words) + rng.choice(("", "_id", "()"))
    if kind != 7 and rng.random() < 0.4:
        return "keyed", rng.choice(PLAIN_NAMES) + rng.choice(("=", ": ", " = ", '": "')), value
    if kind == 7 and rng.random() < 0.5:
        return "url", f"https://{rng.choice(WORDS)}:", value.replace("/", "_")
    return "run", rng.choice(("", " ", "see ", "in ", '"', "/")), value


def _around(rng: random.Random, places: list[str]) -> str:
    """A text of the corpus, made words, or nothing."""
    kind = rng.random()
    if kind < 0.5 and places:
        return rng.choice(places)
    if kind < 0.85:
        words = [rng.choice((str.lower, str.lower, str.title, str.upper))(_word(rng)) for _ in range(8)]
        return rng.choice((" ", " ", "-", "/", "_", ", ")).join(words) + rng.choice(("", "", ".", " 2", "1.4"))
    return ""


def made_findings(count: int, places: list[str], seed: int = SEED) -> list[tuple[str, list[str], int]]:
    """(shape, windows, label) of `count` secrets and as many look-alikes, between pieces of the texts `places`."""
    rng = random.Random(seed)
    out = []
    for label, make in ((1, _secret), (0, _look_alike)):
        for _ in range(count):
            shape, lead, value = make(rng)
            around = ["", ""]
            for i in range(2):
                text = _around(rng, places)
                at = rng.randint(0, max(len(text) - BEFORE, 0))
                around[i] = text[at : at + BEFORE]
            behind = "@" + rng.choice(WORDS) if shape == "url" else rng.choice(("", " ", '"', "'\n", "\n", ".", ","))
            text = f"{around[0]}{rng.choice((' ', chr(10), ''))}{lead}{value}{behind}{rng.choice((' ', ''))}{around[1]}"
            start = text.index(lead + value) + len(lead)
            out.append((shape, windows(text, start, start + len(value)), label))
    return out


def corpus_findings(texts: list[str]) -> list[tuple[str, list[str], int]]:
    """Fixed findings are secrets, of the shape that names them best; other candidates are not."""
    out = []
    for text in texts:
        base = base_spans(text)
        for kind, start, end in base:
            out.append(("keyed" if kind == "assign" else "run", windows(text, start, end), 1))
        out += [(s[0], windows(text, s[1], s[2]), 0) for s in _apart(candidates(text), base)]
    return out


class _Findings:
    """Of each document, as rows for `train`: its own findings, and made ones in places cut out of it."""

    def __init__(self, pairs: int):
        self.pairs = pairs

    def __call__(self, batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"turn": [], "at": [], "shape": [], "label": [], "windows": []}
        for text, turn in zip(batch.column("text").to_pylist(), batch.column("turn").to_pylist()):
            found = corpus_findings([text]) + made_findings(self.pairs, [text], turn)
            out["turn"] += [turn] * len(found)
            out["at"] += range(len(found))
            for name, values in zip(("shape", "windows", "label"), zip(*found)):
                out[name] += values
        return out


def _round(weights: dict[str, np.ndarray], rate: float, until: float) -> Callable[[pa.Table], pa.Table]:
    """Trains a copy of the network on a part of the windows, in an order that is theirs wherever they lie."""

    def work(part: pa.Table) -> pa.Table:
        part = part.sort_by([(name, "ascending") for name in ("turn", "at", "pos", "window")])
        network = Network()
        network.weights = {k: v.copy() for k, v in weights.items()}
        codes, labels = encode(part["window"].to_pylist()), part["label"].to_numpy().astype(np.float32)
        network.train(codes, labels, 1, rate=rate, until=until)
        flat = np.concatenate([v.ravel() for v in network.weights.values()]).astype(float).tolist()
        return pa.table({"part": part["part"][:1], "n": pa.array([len(codes)], pa.int64()), "weights": pa.array([flat])})

    return work


def train(docs: DataFrame, identity: str = "doc_id", text: str = "text", recall: float = RECALL) -> Model:
    """A model from the findings of all documents, and at least `MADE` made secrets and look-alikes in places of theirs.

    Findings are dealt into parts by a hash of document and place. Every round trains a copy of the network on each part,
    all at once; the mean of the copies, weighted by their windows, begins the next round. The findings held out, a third
    of all, reach the driver as counts by shape, label and rounded logit. Neither a task nor the driver holds all findings.
    An empty table is enough.
    """
    known = docs.select(F.col(text).cast("string").alias("text"), F.xxhash64(F.col(identity), F.col(text)).alias("turn"))
    known = known.where(F.length("text") > 0)
    rows = known.count()
    if not rows:
        return fit(made_findings(MADE, []), recall)
    schema = "turn long, at int, shape string, label int, windows array<string>"
    held = F.pmod(F.xxhash64("turn", "at", F.lit(SEED)), F.lit(3)) == 0
    found = stage(by_batch(known, _Findings(-(-MADE // rows)), schema).withColumn("held", held), "findings")

    learn = found.where(~F.col("held")).select("turn", "at", "label", F.posexplode("windows").alias("pos", "window"))
    shown = learn.count()
    parts = min(-(-shown // PART_WINDOWS), MOST_PARTS)
    rounds = 6 if parts == 1 else 3
    part = F.pmod(F.xxhash64("turn", "at", "pos", F.lit(SEED)), F.lit(parts)).alias("part")
    dealt = learn.select("*", part).groupBy("part")
    network = Network()
    for r in range(rounds if shown else 0):
        work = _round(network.weights, RATE * (1 - r / rounds), RATE * (1 - (r + 1) / rounds))
        copies = dealt.applyInArrow(work, "part long, n long, weights array<double>").collect()
        copies.sort(key=lambda c: c.part)
        mean = np.average([c.weights for c in copies], 0, [c.n for c in copies]).astype(np.float32)
        ends = np.cumsum([v.size for v in network.weights.values()])[:-1]
        network.weights = {k: m.reshape(v.shape) for (k, v), m in zip(network.weights.items(), np.split(mean, ends))}

    model = Model(network, 1.0, 0.0, {})

    def judged(batch: pa.RecordBatch) -> dict:
        logits = np.clip(model.logits(batch.column("windows").to_pylist()), -LOGIT, LOGIT)
        bins = np.floor(logits * BINS).astype(np.int64)
        return {"shape": batch.column("shape"), "label": batch.column("label"), "bin": pa.array(bins)}

    counts = by_batch(found.where("held").select("shape", "label", "windows"), judged, "shape string, label int, bin long")
    counts = counts.groupBy("shape", "label", "bin").count().orderBy("shape", "label", "bin").collect()
    columns = [np.array([c[i] for c in counts]) for i in range(4)]
    return _settled(model, columns[0], columns[1], columns[2].astype(float) / BINS, columns[3], recall)


def fit(findings: list[tuple[str, list[str], int]], recall: float = RECALL) -> Model:
    """As `train`, on the given findings alone, in one place: two thirds train, the others calibrate."""
    order = np.random.default_rng(SEED).permutation(len(findings))
    held = set(order[: len(order) // 3].tolist())
    learn = [f for i, f in enumerate(findings) if i not in held]
    rest = [f for i, f in enumerate(findings) if i in held]
    network = Network()
    shown = [(w, label) for _, spans, label in learn for w in spans]
    network.train(encode([w for w, _ in shown]), np.array([label for _, label in shown], np.float32))
    model = Model(network, 1.0, 0.0, {})
    logits = np.clip(model.logits([f[1] for f in rest]), -LOGIT, LOGIT)
    return _settled(model, np.array([f[0] for f in rest]), np.array([f[2] for f in rest]), logits, np.ones(len(rest), int), recall)


def _settled(model: Model, shapes: np.ndarray, labels: np.ndarray, logits: np.ndarray, counts: np.ndarray, recall: float) -> Model:
    """Sets calibration and thresholds by the logits of held-out findings, each as many times as counted."""
    model.slope, model.shift = _calibrated(logits, labels.astype(float), counts)
    scores = model.probability(logits)
    secret = labels == 1
    for shape in SHAPES:
        mine = secret & (shapes == shape)
        # A shape with few secrets takes the threshold of all.
        mine = mine if counts[mine].sum() >= 30 else secret
        order = np.argsort(scores[mine], kind="stable")
        running = np.cumsum(counts[mine][order])
        if len(running):
            least = scores[mine][order][np.searchsorted(running, int((1 - recall) * running[-1]), "right")]
            model.thresholds[shape] = min(0.5, float(least))
        else:
            model.thresholds[shape] = 0.5
    return model


def _calibrated(logits: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit, by Newton steps with a small penalty on leaving slope 1."""
    at = np.array([1.0, 0.0])
    columns = np.stack([logits, np.ones_like(logits)], 1)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(columns @ at, -30, 30)))
        slope = columns.T @ ((p - labels) * counts) + [at[0] - 1, at[1]]
        curve = (columns * (counts * p * (1 - p))[:, None]).T @ columns + np.eye(2)
        at = at - np.linalg.solve(curve, slope)
    return float(max(at[0], 1e-3)), float(at[1])


def find(texts: list[str], model: Model) -> list[list[tuple[str, int, int, float]]]:
    """For each text its findings by start, then kind: (kind, start, end, score)."""
    base = [base_spans(t) for t in texts]
    wide = [_apart(candidates(t), b) for t, b in zip(texts, base)]
    asked = [(i, s) for i, (b, c) in enumerate(zip(base, wide)) for s in b + c]
    scores = model.scores([windows(texts[i], s[1], s[2]) for i, s in asked])
    out: list[list] = [[] for _ in texts]
    for (i, (kind, start, end)), score in zip(asked, scores.tolist()):
        if kind in BASE:
            out[i].append((kind, start, end, score))
        elif score >= model.thresholds[kind]:
            out[i].append((FOUND, start, end, score))
    order = (*BASE, FOUND)
    return [sorted(spans, key=lambda s: (s[1], order.index(s[0]))) for spans in out]


def scan(docs: DataFrame, model: Model, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans) for every row: its findings as (kind, start, end, score) by start, then kind.

    Kinds are those of `BASE`, and `FOUND` for what the network adds; an added span overlaps no other. Places are code
    points, the end exclusive. A null or empty text has no findings; a null id stays null; rows that share an id, or are
    wholly equal, are rows of their own; other columns are ignored; no rows give none. A text is read as a whole.
    """
    kind = docs.schema[identity].dataType.simpleString()
    rows = docs.select(F.col(identity).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def work(batch: pa.RecordBatch) -> dict:
        found = find(batch.column("text").to_pylist(), model)
        names = ("kind", "start", "end", "score")
        return {"id": batch.column("id"), "spans": [[dict(zip(names, s)) for s in spans] for spans in found]}

    return by_batch(rows, work, f"id {kind}, spans {SPANS}")
