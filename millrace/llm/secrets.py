"""Secret scans: fixed patterns, and a linear-chain conditional random field.

The field tags each word as begin (B), inside (I) or outside (O) of a secret from
features of its own shape, of its neighbours and of the text it stands in. It is
trained by maximum likelihood on a bounded sample of documents. Where the fixed patterns
match, the match is also replaced by secrets in disguise, with other names, prefixes,
alphabets and quotes, so the field learns shapes and neighbourhoods, not the patterns. Decoding is Viterbi. Where a word's O score leads by more
than any transitions could make up, the best path surely passes through O there, so
the chain is cut at such words and Viterbi runs on the stretches between, which gives
the same best path as one run over the whole text.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bounded_samples, map_batches

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_SUSPECT = r"(?i)password|passwd|secret|token|api_?key|AKIA|[0-9a-f]{24}"
OUTSIDE, BEGIN, INSIDE = 0, 1, 2
# Bounds of the training sample: documents with a pattern's match, and documents without, their
# length, the stretches taken of one document, the disguised forms made of one match, and those
# put into each document.
SAMPLE_DOCUMENTS, LONGEST_SAMPLE = 300, 20_000
STRETCHES, DISGUISES, INSERTED = 3, 2, 2
_CONTEXT = 8
_REMEMBERED = 400_000
_SWITCH = re.compile(r"[a-z](?=[A-Z])")
_KEYWORD = re.compile(r"(?ai)(?:pass|pwd|secret|token|key|credential|auth|bearer)")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and non-overlapping per kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def word_features(word: str) -> tuple[str, ...]:
    """The shape of a word: length, letter classes, randomness, key words."""
    core = word.strip("\"'`,;.()[]{}<>")
    value = re.split(r"[:=]", core)[-1].strip("\"'") if re.search(r"[:=].", core) else core
    digits = sum(c.isdigit() for c in value)
    size, kinds = len(value), []
    kinds.append(f"len{min(size // 4, 10)}")
    if re.search(r"[:=]", word):
        kinds.append("assigns" if value != core else "sign")
    if digits:
        kinds.append("digits" if digits * 8 >= size else "fewdigits")
    if size >= 12:
        counts = Counter(value)
        bits = -sum(n / size * math.log2(n / size) for n in counts.values())
        kinds.append(f"bits{min(int(bits), 5)}")
        if re.fullmatch(r"[0-9a-f]+", value):
            kinds.append("hexlong")
        if re.fullmatch(r"[A-Z0-9]+", value):
            kinds.append("capslong")
        if re.search(r"[a-z]", value) and re.search(r"[A-Z]", value[1:]) and digits:
            kinds.append("mixedlong")
        if not value.isascii():
            kinds.append("foreign")
    if value.isdigit():
        kinds.append("number")
    switches = len(_SWITCH.findall(value))
    if size >= 12 and switches >= 3:
        kinds.append("switches" if switches < 6 else "manyswitches")
    if size >= 16 and (digits or switches) and re.search(r"[._-]", value):
        kinds.append("joints")
    if re.match(r"[A-Z]{3,4}(?=[A-Z0-9]{8})", value) and digits:
        kinds.append("tagged")
    if _KEYWORD.search(core):
        kinds.append("keyword")
    if "://" in word or "@" in word:
        kinds.append("address")
    if word[0] in "\"'":
        kinds.append("quoted")
    return tuple(kinds)


def file_features(text: str, words: int) -> tuple[str, ...]:
    """What the whole text looks like: share of digits and of code marks."""
    marks = sum(map(text.count, "{};=\"<"))
    return ("marked",) if marks * 20 > words else ()


@dataclass
class Field:
    """A trained field. Scores are of (O, B, I); ``own``, ``left``, ``right`` by feature name."""

    own: dict[str, np.ndarray]
    left: dict[str, np.ndarray]
    right: dict[str, np.ndarray]
    left2: dict[str, np.ndarray]
    file: dict[str, np.ndarray]
    bias: np.ndarray
    transition: np.ndarray

    def __post_init__(self) -> None:
        self.rows: list[np.ndarray] = []
        self.signatures: dict[tuple[str, ...], int] = {}
        self.words: dict[str, int] = {}
        self.lead = 2 * float(self.transition.max() - self.transition.min()) + 1e-6

    def __getstate__(self) -> tuple:
        return self.own, self.left, self.right, self.left2, self.file, self.bias, self.transition

    def __setstate__(self, state: tuple) -> None:
        self.own, self.left, self.right, self.left2, self.file, self.bias, self.transition = state
        self.__post_init__()

    def signature(self, word: str) -> int:
        """The number of the word's feature set; words come by the million, feature sets by the hundred."""
        features = word_features(word)
        number = self.signatures.get(features)
        if number is None:
            number = self.signatures[features] = len(self.rows)
            zero = np.zeros(3)
            sums = [sum((table.get(f, zero) for f in features), zero)
                    for table in (self.own, self.left, self.right, self.left2)]
            self.rows.append(np.array(sums))
        if len(self.words) >= _REMEMBERED:
            self.words.clear()
        self.words[word] = number
        return number

    def scores(self, words: list[str], text: str) -> np.ndarray:
        known = self.words.get
        numbers = np.array([n if (n := known(w)) is not None else self.signature(w) for w in words], dtype=np.int64)
        table = np.array(self.rows)
        scores = table[numbers, 0] + self.bias
        scores[1:] += table[numbers[:-1], 1]
        scores[:-1] += table[numbers[1:], 2]
        scores[2:] += table[numbers[:-2], 3]
        for feature in file_features(text, len(words)):
            scores += self.file.get(feature, 0)
        return scores

    def tag(self, words: list[str], text: str) -> tuple[np.ndarray, np.ndarray]:
        """(places, tags) of the words on the best path that are not O."""
        if not words:
            return np.empty(0, int), np.empty(0, int)
        scores = self.scores(words, text)
        open_ = np.flatnonzero(scores[:, OUTSIDE] - scores[:, 1:].max(axis=1) <= self.lead)
        places, tags = [], []
        for run in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1) if len(open_) else []:
            path = self.best_path(scores[run], run[0] > 0, run[-1] < len(words) - 1)
            places.append(run[path > 0])
            tags.append(path[path > 0])
        if not places:
            return np.empty(0, int), np.empty(0, int)
        return np.concatenate(places), np.concatenate(tags)

    def best_path(self, scores: np.ndarray, after_o: bool, before_o: bool) -> np.ndarray:
        """Viterbi over one stretch, with an O on either side unless the text begins or ends there."""
        best = scores[0] + (self.transition[OUTSIDE] if after_o else 0)
        steps = []
        for row in scores[1:]:
            reach = best[:, None] + self.transition
            steps.append(reach.argmax(axis=0))
            best = reach.max(axis=0) + row
        state = int((best + (self.transition[:, OUTSIDE] if before_o else 0)).argmax())
        path = [state]
        for step in reversed(steps):
            path.append(state := int(step[state]))
        return np.array(path[::-1])


def _random_letters(chance: random.Random, letters: str, least: int, most: int) -> str:
    return "".join(chance.choices(letters, k=chance.randint(least, most)))


def disguised(chance: random.Random) -> tuple[list[str], list[int]]:
    """Words of a secret in a form the patterns do not know, and their tags.

    The field has to learn from shape and context what the patterns tell by key word and
    prefix, so these are varied: names, signs, alphabets, case, prefixes and quotes.
    """
    digits, lower, upper = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    form = chance.randrange(6)
    if form == 0:
        value = _random_letters(chance, digits + "ABCDEF", 24, 64)
    elif form == 1:
        value = _random_letters(chance, upper, 3, 4) + _random_letters(chance, digits + upper, 14, 28)
    elif form == 2:
        joint = chance.choice("_-")
        heads = [_random_letters(chance, lower, 2, 4) for _ in range(chance.randint(1, 2))]
        value = joint.join([*heads, _random_letters(chance, digits + lower + upper, 18, 40)])
    elif form == 3:
        value = ".".join(_random_letters(chance, digits + lower + upper + "_-", 16, 60) for _ in range(3))
    elif form == 4:
        value = _random_letters(chance, lower + upper, 28, 48)
    else:
        value = _random_letters(chance, digits + lower + upper + "+/", 22, 48) + chance.choice(["", "="])
    quote = chance.choice(["", "", '"', "'"])
    value = quote + value + quote + chance.choice(["", "", "", ".", ",", ";", "###"])
    name = chance.choice(
        ["auth", "credential", "bearer", "pwd", "passphrase", "access-key", "private_key", "login", "key", "x"])
    name = chance.choice([name, name.upper(), name.capitalize()])
    shape = chance.randrange(5)
    if shape == 0:
        return [f"{name}{chance.choice('=:')}{value}"], [BEGIN]
    if shape == 1:
        return [f"{name}{chance.choice('=:')}", value], [OUTSIDE, BEGIN]
    if shape == 2:
        return [name, chance.choice(["=", ":", "is"]), value], [OUTSIDE, OUTSIDE, BEGIN]
    if shape == 3:
        return [name, value], [OUTSIDE, BEGIN]
    return [value], [BEGIN]


_ODD = {"digits", "address", "assigns", "keyword", "joints", "switches", "manyswitches", "mixedlong", "capslong"}


def _odd(features: tuple[str, ...]) -> bool:
    """Whether a word looks anything like a secret."""
    return any(f in _ODD for f in features)


def _sequences(texts: list[str]) -> list[tuple[list[tuple[str, ...]], list[str], list[int]]]:
    """Training stretches: word features, file features, tags.

    Per text up to STRETCHES of the words around a pattern's match, each also with DISGUISES in its
    place; up to STRETCHES around odd-looking words that are no match, its middle, and INSERTED with
    a disguised secret put between two words.
    """
    found = []
    for text in texts:
        chance = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
        matches = list(WORD.finditer(text))
        tags = [OUTSIDE] * len(matches)
        for start, end, kind in sorted(base_spans(text)):
            inside = False
            for i, m in enumerate(matches):
                # Of an assignment the value counts as the secret, not the name before it.
                if m.start() < end and m.end() > (end - 1 if kind == "assign" else start):
                    tags[i] = tags[i] or (INSIDE if inside else BEGIN)
                    inside = True
        words, whole = [m[0] for m in matches], file_features(text, len(matches))
        features = [word_features(w) for w in words]

        def stretch(i: int, replaced: tuple[list[str], list[int]] | None = None) -> None:
            lo, hi = max(0, i - _CONTEXT), min(len(words), i + _CONTEXT + 1)
            rows, own = features[lo:hi], tags[lo:hi]
            if replaced:
                # The match goes with the name and sign before it.
                first = i
                while first > lo and i - first < 2 and (_KEYWORD.search(words[first - 1]) or words[first - 1] in "=:"):
                    first -= 1
                rows = [*features[lo:first], *map(word_features, replaced[0]), *features[i + 1 : hi]]
                own = [*tags[lo:first], *replaced[1], *tags[i + 1 : hi]]
            found.append((rows, whole, own))

        def put(hidden: list[str], own: list[int]) -> None:
            """A stretch with words put between two of the text."""
            i = chance.randrange(len(words) + 1)
            lo, hi = max(0, i - _CONTEXT), min(len(words), i + _CONTEXT)
            found.append(([*features[lo:i], *map(word_features, hidden), *features[i:hi]], whole, [*tags[lo:i], *own, *tags[i:hi]]))

        marked = [i for i, t in enumerate(tags) if t]
        for i in chance.sample(marked, min(STRETCHES, len(marked))):
            stretch(i)
            for _ in range(DISGUISES):
                stretch(i, disguised(chance))
        odd = [i for i, f in enumerate(features) if not tags[i] and _odd(f)]
        for i in chance.sample(odd, min(STRETCHES, len(odd))):
            stretch(i)
        if matches:
            stretch(len(matches) // 2)
        for _ in range(INSERTED if matches else 0):
            # However few matches a sample has, the field sees secrets among its words.
            put(*disguised(chance))
        if matches:
            # Long numbers, of cards or accounts, are none.
            put([_random_letters(chance, "0123456789", 8, 24)], [OUTSIDE])
    return found


def train(texts: list[str], steps: int = 120, rate: float = 0.15, decay: float = 2e-3) -> Field:
    """Maximum likelihood by gradient steps (forward-backward on padded stretches).

    Without any tagged word there is nothing to learn: the field then tags all O.
    """
    sequences = _sequences(texts)
    if not any(t for _, _, tags in sequences for t in tags):
        return Field({}, {}, {}, {}, {}, np.array([10.0, 0.0, 0.0]), np.zeros((3, 3)))
    kinds = sorted({f for rows, _, _ in sequences for row in rows for f in row})
    file_kinds = sorted({f for _, whole, _ in sequences for f in whole})
    index = {f: i for i, f in enumerate(kinds)}
    n, longest, width = len(sequences), max(len(t) for _, _, t in sequences), len(kinds)
    own = np.zeros((n, longest + 4, width), dtype=np.float32)
    whole = np.zeros((n, len(file_kinds)), dtype=np.float32)
    gold, valid = np.zeros((n, longest), int), np.zeros((n, longest), bool)
    for s, (rows, file, tags) in enumerate(sequences):
        for t, row in enumerate(rows):
            own[s, t + 2, [index[f] for f in row]] = 1
        whole[s, [file_kinds.index(f) for f in file]] = 1
        gold[s, : len(tags)], valid[s, : len(tags)] = tags, True
    views = [own[:, 2:-2], own[:, 1:-3], own[:, 3:-1], own[:, :-4]]
    file = np.broadcast_to(whole[:, None], (n, longest, whole.shape[1]))
    design = np.concatenate([*views, file, np.ones((n, longest, 1), np.float32)], axis=2) * valid[..., None]
    weights, transition = np.zeros((design.shape[2], 3)), np.zeros((3, 3))
    state = [np.zeros_like(weights), np.zeros_like(transition)]
    flat = design.reshape(-1, design.shape[2])
    onehot = np.eye(3)[gold] * valid[..., None]
    pairs = np.zeros((3, 3))
    both = valid[:, 1:] & valid[:, :-1]
    np.add.at(pairs, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    for _ in range(steps):
        scores = (flat @ weights.astype(np.float32)).reshape(n, longest, 3).astype(np.float64)
        forward, backward = np.zeros_like(scores), np.zeros_like(scores)
        forward[:, 0] = scores[:, 0]
        for t in range(1, longest):
            reach = np.logaddexp.reduce(forward[:, t - 1, :, None] + transition, axis=1) + scores[:, t]
            forward[:, t] = np.where(valid[:, t, None], reach, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            reach = np.logaddexp.reduce(transition + (scores[:, t + 1] + backward[:, t + 1])[:, None], axis=2)
            backward[:, t] = np.where(valid[:, t + 1, None], reach, 0)
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        marginal = np.exp(forward + backward - total[:, None, None]) * valid[..., None]
        joint = np.exp(
            forward[:, :-1, :, None] + transition + (scores + backward)[:, 1:, None] - total[:, None, None, None]
        ) * both[..., None, None]
        gap = (onehot - marginal).reshape(-1, 3).astype(np.float32)
        slope = (flat.T @ gap).astype(np.float64) / n - decay * weights
        slope_t = (pairs - joint.sum(axis=(0, 1))) / n - decay * transition
        for i, (value, grad) in enumerate(((weights, slope), (transition, slope_t))):
            state[i] += grad**2
            value += rate * grad / np.sqrt(state[i] + 1e-8)
    part = [dict(zip(kinds, weights[i * width : (i + 1) * width])) for i in range(4)]
    return Field(*part, dict(zip(file_kinds, weights[4 * width : -1])), weights[-1], transition)


def sample_texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> list[str]:
    """The training sample: up to SAMPLE_DOCUMENTS texts with, and as many without, what the patterns look for.

    The first by hash, of texts up to LONGEST_SAMPLE characters, so neither order nor partitions matter.
    """
    short = df.filter(F.length(text) <= LONGEST_SAMPLE)
    return bounded_samples(short, text, F.col(text).rlike(_SUSPECT), [key], SAMPLE_DOCUMENTS, 11)


def all_spans(field: Field, text: str) -> list[tuple[int, int, str]]:
    """Base spans and the field's, by start, then kind. A field's span that meets a base span is left out."""
    base = sorted(base_spans(text), key=lambda s: (s[0], KINDS.index(s[2])))
    words = WORD.findall(text)
    places, tags = field.tag(words, text)
    if not len(places):
        return base
    wanted = dict(zip(places.tolist(), tags.tolist()))
    last, spans, previous = max(wanted), [], -2
    for i, match in enumerate(WORD.finditer(text)):
        if i in wanted:
            if spans and previous == i - 1 and wanted[i] == INSIDE:
                spans[-1] = (spans[-1][0], match.end(), "crf")
            else:
                spans.append((match.start(), match.end(), "crf"))
            previous = i
        if i >= last:
            break
    free = [s for s in spans if not any(s[0] < e and b < s[1] for b, e, _ in base)]
    return sorted(base + free, key=lambda s: (s[0], KINDS.index(s[2])))


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(df: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: key, counts per base kind, digest of the base spans, all spans.

    NULL texts count as empty: no spans, the digest of nothing. Other columns are ignored.
    """
    kind_of_key = df.schema[key].dataType.simpleString()

    def run(batches: Iterator) -> Iterator[dict]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                spans = all_spans(field, value.as_py() or "")
                base = [s for s in spans if s[2] != "crf"]
                counts = Counter(s[2] for s in base)
                rows.append((counts["assign"], counts["access"], counts["hex"],
                             hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
            columns = zip(*rows) if rows else [[]] * 5
            yield dict(zip(["key", "a", "b", "c", "d", "e"], [batch.column(0), *map(list, columns)]))

    found = map_batches(
        df.select(key, text), run, f"key {kind_of_key}, a long, b long, c long, d string, e string"
    )
    return found.toDF(key, "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def masked(df: DataFrame, field: Field, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every span of its texts replaced by ``mark``; NULL stays NULL, all other columns stay."""
    def cover(value: str | None) -> str | None:
        if not value:
            return value
        parts, at = [], 0
        for start, end, _ in all_spans(field, value):
            if end > at:
                parts += [value[at : max(start, at)], mark] if start >= at else []
                at = end
        return "".join([*parts, value[at:]])

    schema = df.schema

    def run(batches: Iterator) -> Iterator[dict]:
        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            columns[text] = [cover(v.as_py()) for v in columns[text]]
            yield columns

    return map_batches(df, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema))
