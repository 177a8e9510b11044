"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the page.

A page becomes its leaf blocks (text between the starts and ends of block elements) with the tags, classes, ids and roles of
their ancestors and a few properties of the text. The field has two states, main text or not; weights are trained by maximum likelihood
on labelled pages, and Viterbi finds the best states of a page.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from newslens.llm import arrays

# Kinds of HTML elements.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe noembed noframes".split())
HIDDEN = set("head select option button datalist object audio video canvas svg".split())
#: What can stand in a head whose end tag is left out; anything else ends it.
IN_HEAD = set("html head base basefont bgsound link meta noframes noscript script style template title".split())
PLAIN = set("html body div span".split())
CLOSE_P = BLOCKS - {"caption", "body", "html", "tbody", "td", "tfoot", "th", "thead", "tr"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = set("table ul ol dl div article section aside nav header footer main form".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""", re.S)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z]+")
_STATES = 2


@dataclass
class Leaf:
    """A leaf block: its text, names of its ancestors, and how many of its characters are in links."""

    text: str
    names: tuple[str, ...]
    tag: str
    linked: int


def _attribute_names(attributes: str) -> list[str]:
    if "=" not in attributes:
        return []
    values = [double or single or bare for _, double, single, bare in _NAMES.findall(attributes)]
    return [f".{part}" for value in values for part in _PART.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())]


def leaves(page: str) -> list[Leaf]:
    """The leaf blocks of a page in their order. Comments, scripts, styles, drawings, the head and controls of forms are no text; formulas are.

    A head without end tag ends where something comes that cannot stand in it; quotes in a tag count behind an equals sign only. Unclosed and wrongly nested elements are taken as browsers do in the common cases: a block ends a paragraph, an item ends the one
    before, an end tag closes what is open inside, and one that nothing opened is ignored.
    """
    made: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, links, hidden, at = 0, 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                tag = next((name for name, _ in reversed(stack) if name in BLOCKS), "")
                made.append(Leaf(text, stack[-1][1] if stack else (), tag, min(linked, len(text))))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not hidden:
            parts.append(text)
            if links:
                linked += len(text.strip())

    def pop(upto: int) -> None:
        nonlocal links, hidden
        while len(stack) > upto:
            name, _ = stack.pop()
            links -= name == "a"
            hidden -= name in HIDDEN

    def close(names: set[str], within: set[str]) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                pop(k)
                return
            if stack[k][0] in within:
                return

    while token := _TOKEN.search(page, at):
        if hidden and page[at : token.start()].strip():
            close({"head"}, set())
        add(page[at : token.start()])
        at = token.end()
        if token[2] is None:
            continue
        name = token[2].lower()
        if name == "br":
            add(" ")
        elif token[1]:
            if name in BLOCKS:
                flush()
            if any(open_ == name for open_, _ in stack):
                pop(max(k for k, (open_, _) in enumerate(stack) if open_ == name))
        elif name == "xmp":  # its contents are text as they stand
            flush()
            end = re.compile(r"</xmp(?=[\s/>])", re.I).search(page, at)
            close({"head", "svg"}, set())
            add(html.escape(page[at : end.start() if end else len(page)], quote=False))
            flush()
            at = end.start() if end else len(page)
        elif name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
        else:
            if hidden and name not in IN_HEAD:
                close({"head"}, set())
            if name in BLOCKS:
                flush()
                if hidden:
                    close({"svg"}, set())  # a block cannot stand in a drawing: it was left open
                if name in CLOSE_P:
                    close({"p"}, SCOPE)
                if name in SAME:
                    close(SAME[name], {"table", "ul", "ol", "dl"} if name != "tr" else {"table"})
            if name not in VOID and not token[3].endswith("/"):
                own = ([] if name in PLAIN else [name]) + _attribute_names(token[3])
                above = stack[-1][1] if stack else ()
                stack.append((name, above + tuple(part for part in dict.fromkeys(own) if part not in above)))
                links += name == "a"
                hidden += name in HIDDEN
    add(page[at:])
    flush()
    return made


def text_features(leaf: Leaf, position: int, size: int) -> list[str]:
    """Names of the features of a block's text and place."""
    words = leaf.text.count(" ") + 1
    share = leaf.linked / len(leaf.text)
    return [
        f"tag={leaf.tag}",
        f"words={min(6, words.bit_length())}",
        f"links={0 if share < 0.05 else 1 if share < 0.5 else 2}",
        f"stop={leaf.text[-1] in '.!?…。！？:;'}",
        f"sign={'©' in leaf.text or '|' in leaf.text[:40]}",
        f"place={0 if position == 0 else 2 if position == size - 1 else 1}",
    ]


class Field:
    """Weights of the features and of the steps between states."""

    def __init__(self, weights: dict[str, float], steps: np.ndarray):
        self.weights, self.steps = weights, steps

    def scores(self, page: list[Leaf]) -> list[float]:
        """For each block how much its features speak for main text."""
        get, known, made = self.weights.get, {}, []
        for k, leaf in enumerate(page):
            if leaf.names not in known:
                known[leaf.names] = sum(get(name, 0.0) for name in leaf.names)
            made.append(known[leaf.names] + sum(get(name, 0.0) for name in text_features(leaf, k, len(page))))
        return made

    def states(self, page: list[Leaf]) -> list[bool]:
        """Viterbi: the most probable states, not main text on equal scores."""
        (aa, ab), (ba, bb) = self.steps.tolist()
        other, main, back = 0.0, 0.0, []
        for k, score in enumerate(self.scores(page)):
            if k:
                from_other = (other + aa, main + ba)
                from_main = (other + ab, main + bb)
                back.append((from_other[1] > from_other[0], from_main[1] > from_main[0]))
                other, main = max(from_other), max(from_main)
            main += score
        states = [main > other]
        for choice in reversed(back):
            states.append(choice[states[-1]])
        return states[::-1] if page else []

    def text(self, page: str) -> str:
        blocks = leaves(page)
        return "\n\n".join(leaf.text for leaf, main in zip(blocks, self.states(blocks), strict=True) if main)


def train(pages: list[tuple[list[Leaf], list[bool]]], rounds: int = 120, penalty: float = 0.002) -> Field:
    """Maximum likelihood with an L2 penalty, by Adam over all pages at once; forward and backward sums run over padded pages."""
    counts = [[Counter([*leaf.names, *text_features(leaf, k, len(page))]) for k, leaf in enumerate(page)] for page, _ in pages]
    names = sorted({name for page in counts for block in page for name in block})
    number = {name: k for k, name in enumerate(names)}
    length = max(len(page) for page in counts)
    values = np.zeros((length, len(pages), len(names)), np.float32)
    truth, mask = np.zeros((length, len(pages)), int), np.zeros((length, len(pages)), bool)
    for p, (page, (_, labels)) in enumerate(zip(counts, pages, strict=True)):
        for t, block in enumerate(page):
            for name, times in block.items():
                values[t, p, number[name]] = times
            truth[t, p], mask[t, p] = labels[t], True
    weights, steps = np.zeros(len(names)), np.zeros((_STATES, _STATES))
    moments = [np.zeros(len(names) + 4) for _ in range(2)]
    flat, total = values[mask], mask.sum()
    del values
    for turn in range(1, rounds + 1):
        emit = np.zeros((*mask.shape, _STATES))
        emit[mask, 1] = flat @ weights.astype(np.float32)
        forward, backward = np.zeros_like(emit), np.zeros_like(emit)
        forward[0] = emit[0]
        for t in range(1, length):
            ahead = np.logaddexp.reduce(forward[t - 1][:, :, None] + steps, axis=1) + emit[t]
            forward[t] = np.where(mask[t][:, None], ahead, forward[t - 1])
        for t in range(length - 2, -1, -1):
            ahead = np.logaddexp.reduce(steps + (emit[t + 1] + backward[t + 1])[:, None, :], axis=2)
            backward[t] = np.where(mask[t + 1][:, None], ahead, 0)
        norm = np.logaddexp.reduce(forward[-1], axis=-1)
        main = np.where(mask, np.exp(forward[..., 1] + backward[..., 1] - norm), 0)
        gradient = ((truth - main)[mask].astype(np.float32) @ flat) / total - penalty * weights / len(pages)
        pair = forward[:-1][..., :, None] + steps + (emit[1:] + backward[1:])[..., None, :] - norm[None, :, None, None]
        expected = np.where(mask[1:][..., None, None], np.exp(pair), 0).sum(axis=(0, 1))
        seen = np.zeros((_STATES, _STATES))
        np.add.at(seen, (truth[:-1][mask[1:]], truth[1:][mask[1:]]), 1)
        whole = np.concatenate([gradient, ((seen - expected) / total - penalty * steps / len(pages)).reshape(-1)])
        moments[0] = 0.9 * moments[0] + 0.1 * whole
        moments[1] = 0.99 * moments[1] + 0.01 * whole**2
        move = 0.1 * (moments[0] / (1 - 0.9**turn)) / (np.sqrt(moments[1] / (1 - 0.99**turn)) + 1e-8)
        weights, steps = weights + move[:-4], steps + move[-4:].reshape(steps.shape)
    return Field(dict(zip(names, weights.tolist(), strict=True)), steps)


# What sites call the parts of a page.
MAIN_NAMES = "content main article post entry story body text articlebody postcontent entrycontent maincontent".split()
AROUND = {
    "nav": "nav navbar menu navigation topnav breadcrumb breadcrumbs pagination toc skip".split(),
    "header": "header masthead banner branding topbar logo site".split(),
    "footer": "footer bottom copyright colophon legal".split(),
    "aside": "sidebar aside related widget recommended trending popular more tags author bio".split(),
    "ad": "ad ads advert advertisement adbox sponsor sponsored promo promotion banner".split(),
    "notice": "cookie consent gdpr notice alert popup modal overlay paywall warning".split(),
    "form": "form search login subscribe newsletter signup contact".split(),
    "comments": "comments comment reply replies discussion disqus respond thread user reader".split(),
    "share": "share social sharing follow buttons".split(),
}
#: Generated labelled pages that the field is trained on.
TRAINING_PAGES = 400


def _words(rng: random.Random, low: int, high: int) -> str:
    return " ".join("".join(rng.choice("aeioubcdlmnrstéüñ") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(low, high)))


def _sentences(rng: random.Random, low: int, high: int) -> str:
    return " ".join(_words(rng, 4, 16).capitalize() + rng.choice("....?!") for _ in range(rng.randint(low, high)))


def _around(rng: random.Random, kind: str) -> str:
    """One part that is not main text, in the tag or under the names that sites use."""
    tags = {"nav": ["nav"], "header": ["header"], "footer": ["footer"], "aside": ["aside"], "form": ["form"], "comments": ["section", "ol"]}
    own = rng.choice(tags.get(kind, []) + ["div", "section"])
    named = own in ("div", "section", "ol") or rng.random() < 0.3
    name = rng.choice(AROUND[kind])
    attribute = f' {rng.choice(["class", "class", "id", "role"])}="{name}{rng.choice(["", "", "-box", " wide", "-1"])}"' if named else ""
    inside = {
        "nav": lambda: "<ul>" + "".join(f"<li><a href='/{k}'>{_words(rng, 1, 3)}</a></li>" for k in range(rng.randint(2, 8))) + "</ul>",
        "header": lambda: rng.choice([f"<h1>{_words(rng, 1, 4)}</h1>", f"<a href='/'>{_words(rng, 1, 3)}</a>"]) + f"<p>{_words(rng, 2, 8)}</p>",
        "footer": lambda: rng.choice(["&copy; ", "© 2024 ", ""]) + _words(rng, 1, 4) + rng.choice([" &middot; ", " | "]) + rng.choice([_words(rng, 2, 6), _sentences(rng, 1, 2)]),
        "aside": lambda: f"<h3>{_words(rng, 1, 4)}</h3>" + rng.choice([f"<p>{_sentences(rng, 1, 3)}</p>", "<ul>" + "".join(f"<li><a href='#'>{_words(rng, 2, 7)}</a>" for _ in range(4)) + "</ul>"]),
        "ad": lambda: rng.choice([_sentences(rng, 1, 3), f"<p>{_sentences(rng, 1, 2)}</p>", f"<a href='#'>{_words(rng, 2, 8)}</a>"]),
        "notice": lambda: f"<p>{_sentences(rng, 1, 3)}</p><button>OK</button>",
        "form": lambda: f"<label>{_words(rng, 1, 4)}</label><input name='q'><p>{_words(rng, 2, 9)}</p><button>{_words(rng, 1, 2)}</button>",
        "comments": lambda: "".join(f"<{t} class='{rng.choice(['comment', 'reply', 'item'])}'><b>{_words(rng, 1, 2)}</b><p>{_sentences(rng, 1, 5)}</p></{t}>" for t in [rng.choice(["div", "li", "article"])] * rng.randint(1, 5)),
        "share": lambda: "".join(f"<a href='#'>{_words(rng, 1, 2)}</a> " for _ in range(4)),
    }
    return f"<{own}{attribute}>{inside[kind]()}</{own}>"


def _main(rng: random.Random) -> str:
    title = f"<h1>{_words(rng, 3, 12)}</h1>"
    blocks = [title if rng.random() < 0.8 else ""]
    if blocks[0] and rng.random() < 0.2:
        blocks[0] = f"<header>{title}</header>"
    for _ in range(rng.choice([1, rng.randint(1, 14)])):
        text = _sentences(rng, 1, rng.choice([1, 9]))
        kinds = (
            [f"<p>{text}</p>"] * 12
            + [f"<p><b>{_words(rng, 1, 9)}.</b><br><p>{text}</p>", f"<h2>{_words(rng, 1, 7)}</h2>", f"<blockquote>{text}</blockquote>"]
            + [f"<pre>{_words(rng, 3, 20)}</pre>", f"<p>{_words(rng, 1, 3)} <a href='#'>{_words(rng, 1, 4)}</a> {text}</p>"]
            + ["<ul>" + "".join(f"<li>{_words(rng, 1, 12)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>", f"<p>{_words(rng, 1, 4)}</p>"]
            + [f"<table><tr><th>{_words(rng, 1, 2)}</th><td>{_words(rng, 1, 3)}</td></tr></table>", f"<figure><figcaption>{_words(rng, 2, 9)}</figcaption></figure>"]
        )
        blocks.append(rng.choice(kinds))
    return "".join(blocks)


def labelled_pages(how_many: int = TRAINING_PAGES, seed: int = 7) -> list[tuple[list[Leaf], list[bool]]]:
    """Pages of generated words in varied layouts, with the truth for every block. The seed fixes them."""
    rng, made = random.Random(seed), []
    for _ in range(how_many):
        bare = rng.random() < 0.2
        before = [] if bare else [_around(rng, kind) for kind in ("nav", "header", "ad", "notice", "form", "share", "aside") if rng.random() < 0.35]
        after = [] if bare else [_around(rng, kind) for kind in ("comments", "aside", "footer", "share", "ad", "form", "nav", "notice") if rng.random() < 0.4]
        tag = rng.choice(["article", "article", "article", "main", "div", "div", "section"])
        name = f' {rng.choice(["class", "id"])}="{rng.choice(MAIN_NAMES)}"' if tag in ("div", "section") or rng.random() < 0.3 else ""
        inner = _main(rng)
        inside = _around(rng, rng.choice(["ad", "share", "aside", "notice", "comments"])) if rng.random() < 0.25 else ""
        pieces = [(part, False) for part in before] + [(f"<{tag}{name}>", None), (inner, True), (inside, False), (f"</{tag}>", None)]
        pieces += [(part, False) for part in after]
        blocks = leaves("<html><head><title>x</title></head><body>" + "".join(part for part, _ in pieces) + "</body></html>")
        labels = _truth(pieces, blocks)
        if labels is not None:
            made.append((blocks, labels))
    return made


def _truth(pieces: list[tuple[str, bool | None]], blocks: list[Leaf]) -> list[bool] | None:
    """Labels by the texts of the parts in their order; None if a page does not come apart as it was put together."""
    expected = [(leaf.text, bool(label)) for part, label in pieces if label is not None for leaf in leaves(part)]
    return [label for _, label in expected] if [text for text, _ in expected] == [leaf.text for leaf in blocks] else None


@lru_cache(1)
def default_field() -> Field:
    """Trained once per process."""
    return train(labelled_pages())


def main_text(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every row of (page_id, url, html), in one narrow pass.

    A null or empty page, or one without main text, gives an empty text. Blocks of all lengths are kept whole; repeated rows give equal
    results; other columns are not read. Without ``field`` one is trained here on TRAINING_PAGES generated pages.
    """
    own = field or default_field()
    kinds = {f.name: f.dataType.simpleString() for f in pages.select("page_id", "url").schema}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [own.text(page) if page else "" for page in batch.column("html").to_pylist()]
        sizes = pa.array([len(text) for text in texts], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return arrays.map_batches(pages.select("page_id", "url", "html"), work, schema)
