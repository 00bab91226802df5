"""HTML extraction by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags, each with the
path of open tags (name, class, id, role). A block's vector joins hashed entries of its
path, a hashed bag of all its words, and a few counts. A bidirectional LSTM in numpy
reads the vectors of all blocks of a page in order and labels every block as main text
or not, so a block is judged in view of the whole page.

The model is trained here on a bounded sample of pages. Their blocks are labelled by
the page's own markup (inside ``article`` or ``main``, not inside page furniture), and
each sampled page also comes in a variant with more furniture put in.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bounded_sample, map_batches

# Bounds of the training sample: pages, their length and their blocks.
SAMPLE_PAGES, LONGEST_SAMPLE, MOST_BLOCKS = 120, 60_000, 300
PATH_SLOTS, WORD_SLOTS, COUNTS, HIDDEN = 96, 32, 4, 24
_PAGES_AT_ONCE = 128
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WHITE = re.compile(r"\s+")
# Tags by their place in HTML: no content, content that is no text, and content that flows within a line.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title svg iframe object canvas select head".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike "
                    "strong sub sup time tt u var wbr label".split())
_ENDS_P = frozenset("p div ul ol li table section article aside header footer nav form h1 h2 h3 h4 h5 h6 pre blockquote".split())
_FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:nav|menu|header|footer|side|sidebar|aside|ad|ads|advert|banner|promo|cookie|notice|comment|comments|"
    r"form|share|social|related|breadcrumb|subscribe|newsletter)", re.I)
_FURNITURE_TAGS = frozenset("nav header footer aside form button".split())
_MAIN_TAGS = frozenset(("article", "main"))


@dataclass(frozen=True, slots=True)
class Block:
    path: tuple[str, ...]
    text: str
    linked: float


def _name(tag: str, attributes: str) -> str:
    if not attributes:
        return tag
    found = [a or b or c for a, b, c in _NAMED.findall(attributes)]
    return f"{tag}.{' '.join(found).lower()}" if found else tag


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order, texts decoded and with single spaces."""
    found: list[Block] = []
    stack: list[str] = []
    names: list[str] = []
    run: list[str] = []
    linked = 0

    def close() -> None:
        nonlocal linked
        if run:
            text = _WHITE.sub(" ", html.unescape("".join(run))).strip()
            if text:
                found.append(Block(tuple(stack), text, min(1.0, linked / len(text))))
            run.clear()
            linked = 0

    at, size = 0, len(page)
    while at < size:
        match = _TAG.search(page, at)
        piece = page[at : match.start()] if match else page[at:]
        if piece:
            run.append(piece)
            if "a" in names:
                linked += len(piece)
        if not match:
            break
        at, tag = match.end(), (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:
            if tag in names:
                depth = len(names) - 1 - names[::-1].index(tag)
                if any(n not in _INLINE for n in names[depth:]):
                    close()
                del names[depth:], stack[depth:]
            continue
        if tag == "br":
            run.append(" ")
            continue
        if tag not in _INLINE:
            close()
            if tag in _ENDS_P and "p" in names:
                # An open paragraph ends, with the inline tags left open in it.
                depth = len(names) - 1 - names[::-1].index("p")
                if all(n in _INLINE for n in names[depth + 1 :]):
                    del names[depth:], stack[depth:]
        if tag in _RAW and not match[3].rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else (size if tag in ("script", "style") else at)
            continue
        if tag not in _VOID and not match[3].rstrip().endswith("/"):
            names.append(tag)
            stack.append(_name(tag, match[3]))
    close()
    return found


def weak_label(block: Block) -> int:
    """1 for text inside ``article`` or ``main`` and no page furniture below it."""
    tags = [p.split(".", 1) for p in block.path]
    inside = [i for i, t in enumerate(tags) if t[0] in _MAIN_TAGS]
    if not inside:
        return 0
    below = tags[inside[0] + 1 :]
    return int(not any(t[0] in _FURNITURE_TAGS or (len(t) > 1 and _FURNITURE.search(t[1])) for t in below))


_hashes: dict[str, tuple[int, float]] = {}


def _slot(word: str, slots: int) -> tuple[int, float]:
    known = _hashes.get(word)
    if known is None:
        if len(_hashes) > 200_000:
            _hashes.clear()
        code = zlib.crc32(word.encode("utf-8", "replace"))
        known = _hashes[word] = (code >> 1, 1.0 if code & 1 else -1.0)
    return known[0] % slots, known[1]


def vectors(page: list[Block]) -> np.ndarray:
    """One row per block: hashed path, hashed words, counts."""
    rows = np.zeros((len(page), PATH_SLOTS + WORD_SLOTS + COUNTS), dtype=np.float32)
    for row, block in zip(rows, page):
        for entry in {e for p in block.path for e in (p.split(".", 1)[0], *re.findall(r"[a-z]+", p.partition(".")[2]))}:
            slot, sign = _slot("<" + entry, PATH_SLOTS)
            row[slot] += sign
        words = block.text.split()
        slots = np.array([_slot(w, WORD_SLOTS) for w in words])
        bag = np.bincount(slots[:, 0].astype(int), slots[:, 1], WORD_SLOTS)
        row[PATH_SLOTS : PATH_SLOTS + WORD_SLOTS] = bag / max(1.0, np.sqrt((bag**2).sum()))
        row[-COUNTS:] = (np.log1p(len(words)) / 5, block.linked, block.text[-1] in ".!?\"'", len(block.path) / 10)
    return rows


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(len(p) for p in pages)
    x = np.zeros((longest, len(pages), pages[0].shape[1]), dtype=np.float32)
    valid = np.zeros((longest, len(pages), 1), dtype=np.float32)
    for i, p in enumerate(pages):
        x[: len(p), i], valid[: len(p), i] = p, 1
    return x, valid


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(x: np.ndarray, valid: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states of one direction; padding keeps the state as it is."""
    steps, n, hidden = x.shape[0], x.shape[1], u.shape[0]
    h, c = np.zeros((n, hidden), np.float32), np.zeros((n, hidden), np.float32)
    inputs, out, kept = x @ w + b, np.zeros((steps, n, hidden), np.float32), []
    for t in range(steps):
        gates = inputs[t] + h @ u
        i, f, o = (_sigmoid(gates[:, k * hidden : (k + 1) * hidden]) for k in range(3))
        g = np.tanh(gates[:, 3 * hidden :])
        new_c = f * c + i * g
        tanh_c = np.tanh(new_c)
        kept.append((h, c, i, f, o, g, tanh_c))
        h = valid[t] * (o * tanh_c) + (1 - valid[t]) * h
        c = valid[t] * new_c + (1 - valid[t]) * c
        out[t] = h
    return out, kept


def _backward(x, valid, u, kept, slope) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of w, u and b from those of the hidden states."""
    dh, dc = np.zeros_like(slope[0]), np.zeros_like(slope[0])
    gates = np.zeros((*slope.shape[:2], 4 * slope.shape[2]), np.float32)
    du = np.zeros_like(u)
    for t in range(len(kept) - 1, -1, -1):
        h, c, i, f, o, g, tanh_c = kept[t]
        total = dh + slope[t]
        own = valid[t] * total
        cell = valid[t] * dc + own * o * (1 - tanh_c**2)
        parts = (cell * g * i * (1 - i), cell * c * f * (1 - f), own * tanh_c * o * (1 - o), cell * i * (1 - g**2))
        gates[t] = np.concatenate(parts, axis=1)
        du += h.T @ gates[t]
        dh = gates[t] @ u.T + (1 - valid[t]) * total
        dc = cell * f + (1 - valid[t]) * dc
    flat = gates.reshape(-1, gates.shape[2])
    return x.reshape(-1, x.shape[2]).T @ flat, du, flat.sum(axis=0)


class Labeller:
    """The bidirectional LSTM and its output layer."""

    def __init__(self, inputs: int, hidden: int = HIDDEN, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        shapes = [(inputs, 4 * hidden), (hidden, 4 * hidden), (4 * hidden,)] * 2 + [(2 * hidden, 1), (1,)]
        self.weights = [
            (rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 else np.zeros(s)).astype(np.float32) for s in shapes
        ]

    def _run(self, x: np.ndarray, valid: np.ndarray) -> tuple:
        w = self.weights
        ahead, kept_a = _forward(x, valid, *w[:3])
        # Padding comes first in the reversed order and keeps the state at zero.
        back, kept_b = _forward(x[::-1], valid[::-1], *w[3:6])
        both = np.concatenate([ahead, back[::-1]], axis=2)
        return both, kept_a, kept_b, _sigmoid(both @ w[6] + w[7])

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 14, rate: float = 0.01, size: int = 24) -> None:
        """Adam on the cross entropy, back-propagated through whole pages."""
        rng = np.random.default_rng(3)
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(pages))
            for start in range(0, len(order), size):
                chosen = sorted(order[start : start + size], key=lambda i: len(pages[i]))
                x, valid = _padded([pages[i] for i in chosen])
                y, _ = _padded([labels[i][:, None].astype(np.float32) for i in chosen])
                both, kept_a, kept_b, p = self._run(x, valid)
                slope = (p - y) * valid / valid.sum()
                d_out = [both.reshape(-1, both.shape[2]).T @ slope.reshape(-1, 1), slope.sum(axis=(0, 1))]
                d_both = slope @ self.weights[6].T
                half = both.shape[2] // 2
                grads = [
                    *_backward(x, valid, self.weights[1], kept_a, d_both[..., :half]),
                    *_backward(x[::-1], valid[::-1], self.weights[4], kept_b, d_both[::-1, :, half:]),
                    *d_out,
                ]
                step += 1
                for i, grad in enumerate(grads):
                    grad = np.clip(grad, -1, 1)
                    first[i] = 0.9 * first[i] + 0.1 * grad
                    second[i] = 0.99 * second[i] + 0.01 * grad**2
                    rise = first[i] / (1 - 0.9**step)
                    self.weights[i] = self.weights[i] - (rate * rise / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page is main text."""
        filled = [i for i, p in enumerate(pages) if len(p)]
        found = [np.zeros(len(p), bool) for p in pages]
        # Pages of like length are read together, so padding stays small.
        filled.sort(key=lambda i: len(pages[i]))
        for start in range(0, len(filled), _PAGES_AT_ONCE):
            chosen = filled[start : start + _PAGES_AT_ONCE]
            p = self._run(*_padded([pages[i] for i in chosen]))[3]
            for column, i in enumerate(chosen):
                found[i] = p[: len(pages[i]), column, 0] > 0.5
        return found


_FILLERS = (
    '<header class="site-header"><a href="/">{0}</a><p>{1}</p></header>',
    '<aside class="sidebar"><h3>{0}</h3><ul><li><a href="/x">{1}</a></li></ul></aside>',
    '<div class="cookie-notice" role="dialog"><p>{1}</p><button>{0}</button></div>',
    '<div class="advert"><p>{1}</p></div>',
    '<div class="ad">{1}</div>',
    '<form action="/s"><label>{0}</label><input name="q"><p>{1}</p></form>',
    '<nav class="menu"><ul><li><a href="/a">{0}</a></li><li><a href="/b">{1}</a></li></ul></nav>',
    '<section class="comments"><h2>{0}</h2><div class="comment"><p>{1}</p></div><div class="comment"><p>{1}</p></div></section>',
    '<div id="comments"><p>{1}</p></div>',
    '<div class="related"><h3>{0}</h3><p>{1}</p></div>',
    '<footer class="page-footer"><p>{1}</p></footer>',
)


# What main text is made of besides paragraphs.
_CONTENTS = (
    "<table><tr><td>{0}</td><td>{1}</td></tr><tr><td>{1}</td><td>{0}</td></tr></table>",
    "<figure><img src='i.png'><figcaption>{1}</figcaption></figure>",
    "<blockquote><p>{1}</p></blockquote>",
    "<pre>{1}</pre>",
    "<ul><li>{0}</li><li>{1}</li></ul>",
    "<h2>{0}</h2><p>{1}</p>",
    "<blockquote>{1}</blockquote>",
)
# Other names for the same places; an empty one takes the name away.
_ALIASES = {
    "article": ("content", "post", "post-body", "entry", "story", "text", "page-content", "", "", ""),
    "site-header": ("top", "masthead", "logo-row"), "sidebar": ("rail", "col-right", "widgets"),
    "cookie-notice": ("gdpr", "overlay", "consent"), "advert": ("sponsor", "slot-3", "dfp"), "ad": ("sponsor", "box-300", "dfp"),
    "menu": ("links", "topbar", "nav-list"), "related": ("more", "read-next", "teasers"), "page-footer": ("bottom", "legal", "imprint"),
    "comments": ("replies", "disqus_thread", "feedback", "responses", "discussion"), "comment": ("reply", "response", "note"),
}
_AS_DIVISION = ("article", "main", "header", "footer", "aside", "nav")


def _put_in(page: str, seed: int) -> str:
    """The page with furniture before, inside and after the article, and more kinds of main text in it."""
    rng = np.random.default_rng(seed)
    words = re.sub(r"<[^>]*>", " ", page).split() or ["-"]

    def filled(forms: tuple[str, ...]) -> str:
        def text(n: int) -> str:
            start = int(rng.integers(len(words)))
            return " ".join(words[start : start + n])

        return forms[rng.integers(len(forms))].format(text(2), text(int(rng.integers(3, 40))))

    changed = page
    for tag in ("<article", "<main", "</article>", "</main>"):
        if tag in changed and rng.random() < 0.8:
            changed = changed.replace(tag, filled(_FILLERS) + tag, 1)
        if tag.startswith("</") and tag in changed and rng.random() < 0.6:
            changed = changed.replace(tag, tag + filled(_FILLERS), 1)
        if tag.startswith("</") and tag in changed:
            # Main text comes before what the article ends with.
            parts = re.split(r"(?<=</p>)", changed)
            ends = [i for i, part in enumerate(parts) if tag in part]
            for at in sorted(rng.integers(1, max(2, ends[0] if ends else 1), size=int(rng.integers(0, 4))), reverse=True):
                if any("<article" in p or "<main" in p for p in parts[:at]) and not any(tag in p for p in parts[:at]):
                    parts.insert(int(at), filled(_CONTENTS))
            changed = "".join(parts)
    return changed


def _disguised(page: str, seed: int) -> str:
    """The page with other tags and names for its parts; its blocks stay the same, one by one."""
    rng = np.random.default_rng(seed)
    names = {name: others[rng.integers(len(others))] for name, others in _ALIASES.items()}
    kept = names if rng.random() < 0.85 else {"article": names["article"]}

    def renamed(match: re.Match) -> str:
        found = [kept.get(n, n) for n in match[2].split()]
        value = " ".join(n for n in found if n)
        return f' {match[1]}="{value}"' if value else ""

    changed = re.sub(r"""\s(class|id)="([^"]*)\"""", renamed, page)
    for tag in _AS_DIVISION:
        if tag in ("article", "main") or rng.random() < 0.5:
            new = ("div", "div", "section")[rng.integers(3)]
            name = names["article"] if tag in ("article", "main") else ""
            changed = re.sub(rf"<{tag}\b", f'<{new} class="{name}"' if name else f"<{new}", changed, flags=re.I)
            changed = re.sub(rf"</{tag}\s*>", f"</{new}>", changed, flags=re.I)
    return changed


def training_pages(page: str, seed: int) -> list[tuple[list[Block], np.ndarray]]:
    """(blocks, labels) of the page, of it with more put in, and of both in disguise.

    Labels come from the markup the page has by itself; a disguise takes them over block by block.
    """
    found = []
    for variant, whole in ((0, page), (1, _put_in(page, seed))):
        read = blocks(whole)
        labels = np.array([weak_label(b) for b in read])
        found.append((read, labels))
        other = blocks(_disguised(whole, 2 * seed + variant))
        if [b.text for b in other] == [b.text for b in read]:
            found.append((other, labels))
    return [(read[:MOST_BLOCKS], labels[:MOST_BLOCKS]) for read, labels in found if read]


def train(pages: list[str]) -> Labeller:
    """A labeller from sample pages; without any page it labels by an untrained net's bias towards nothing."""
    model = Labeller(PATH_SLOTS + WORD_SLOTS + COUNTS)
    found = [example for i, page in enumerate(pages) for example in training_pages(page, i)]
    if found:
        model.fit([vectors(read) for read, _ in found], [labels for _, labels in found])
    else:
        model.weights[-1] = np.full(1, -20, np.float32)
    return model


def sample_pages(df: DataFrame, key: str = "page_id", page: str = "html") -> list[str]:
    """The SAMPLE_PAGES first pages by hash among those with a main element, of up to LONGEST_SAMPLE characters."""
    fit = df.filter(F.col(page).rlike("(?i)<(article|main)\\b") & (F.length(page) <= LONGEST_SAMPLE))
    return bounded_sample(fit, page, [key], SAMPLE_PAGES, 3)


def extract(df: DataFrame, model: Labeller, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per row of ``df``: key, url, ``text`` and ``n_chars``.

    NULL and empty pages give an empty text. Blocks labelled main text are joined in
    order by one space. Rows with the same key are read each for itself; other columns
    are ignored.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator) -> Iterator[dict]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4 * _PAGES_AT_ONCE):
                part = batch.slice(start, 4 * _PAGES_AT_ONCE)
                read = [blocks(v.as_py() or "") for v in part.column(2)]
                labels = model.label([vectors(b) for b in read])
                texts = [" ".join([b.text for b, keep in zip(p, kept) if keep]) for p, kept in zip(read, labels)]
                yield {"key": part.column(0), "url": part.column(1), "text": texts, "n": [len(t) for t in texts]}

    found = map_batches(df.select(key, url, page), run, f"key {kind}, url string, text string, n long")
    return found.toDF(key, url, "text", "n_chars")
