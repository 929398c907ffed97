"""HTML extraction by equivalence-class template deduction over the pages of a host."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import store

SALTS = 32
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|title|noscript|template|iframe|svg|select|button)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
# HTML's void elements, its inline elements, and names that mark what is no article.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set("a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
_ASIDE_TAGS = set("nav header footer aside form head menu dialog fieldset figure object".split())
_ASIDE_NAMES = set(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies footer header menu nav navbar "
    "navigation newsletter notice notices popup promo related share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)


_TOP = 0  # the path of no element, which stands once on every page


def _digest(path: int, part: str) -> int:
    return xxhash.xxh3_64_intdigest(part.encode("utf-8", "surrogatepass"), path & (1 << 64) - 1) - (1 << 63)


class Run:
    """A run of text in one block: the paths of its open elements, outermost first, and whether these make it an aside."""

    __slots__ = ("paths", "text", "aside", "main")

    def __init__(self, paths: tuple[int, ...], text: str, aside: bool, main: bool):
        self.paths, self.text, self.aside, self.main = paths, text, aside, main

    def token(self) -> int:
        return _digest(self.paths[-1], "\0" + self.text)


def runs(page: str | None, opened: list[int] | None = None) -> list[Run]:
    """Text runs of a page in order. A new block begins at every tag that is not inline.

    The path of each element that is neither an aside nor in one is added to `opened`, if given.
    """
    given, out, buffer = page or "", [], []
    stack: list[tuple[str, bool, bool, int]] = []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            out.append(Run((_TOP, *[s[3] for s in stack]), text, any(s[1] for s in stack), any(s[2] for s in stack)))

    at = 0
    for m in _TOKEN.finditer(given):
        buffer.append(given[at : m.start()])
        at = m.end()
        tag = (m.group("tag") or "").lower()
        if not tag or tag in _INLINE:
            continue
        flush()
        if tag in _VOID:
            continue
        if m.group("end"):
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0].split(".")[0] == tag), None)
            if depth is not None:
                del stack[depth:]
            continue
        if tag in ("p", "li", "td", "tr", "dt", "dd", "option") and stack and stack[-1][0].split(".")[0] == tag:
            stack.pop()
        names = {n for g in _NAMES.findall(m.group("attrs") or "") for n in re.split(r"[\s_-]+", "".join(g).lower()) if n}
        # The article's own header holds its title.
        inside = any(s[2] for s in stack)
        aside = (tag in _ASIDE_TAGS and not (inside and tag in ("header", "figure"))) or bool(names & _ASIDE_NAMES and tag not in ("html", "body", "article", "main"))
        name = tag + "".join("." + n for n in sorted(names))
        stack.append((name, aside, tag in ("article", "main"), _digest(stack[-1][3] if stack else _TOP, name)))
        if opened is not None and not any(s[1] for s in stack):
            opened.append(stack[-1][3])
    buffer.append(given[at:])
    flush()
    return out


def host_of(url: str | None) -> str:
    return re.sub(r"^[a-z][a-z0-9+.-]*://", "", url or "", flags=re.I).split("/")[0].split("?")[0].split("#")[0].lower()


def _slots(kept: list[Run], classes: dict[int, int]) -> list[Run]:
    """The runs that are not in the class of an element around them; `classes` gives the valid class of a token."""
    out = []
    for r in kept:
        own = classes.get(r.token())
        if own is None or all(classes.get(path) != own for path in r.paths):
            out.append(r)
    return out


def extract_pages(
    spark: SparkSession, pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", support: int = 3, share: float = 0.5
) -> DataFrame:
    """Every page with `text`, its main text, and `n_chars`.

    Tokens are the paths of elements and the text runs with their path, in articles as elsewhere. Two tokens of a
    host are equivalent when they have the same occurrence vector over its pages; the vector is kept as page count,
    total count and two sums of page hashes, so that no host is ever in one task. A class is valid with at least
    `support` pages and `share` of the host's. Classes nest by the paths: a run is fixed text of the template when it
    is in the valid class of an element around it, so that it stands there whenever that element does. What remains
    are slots. A text that half the pages share, as of an article carried many times, is a slot where its elements
    also hold other texts.

    The slots outside of menus, headers, footers, notices and their like are the main text. The markup checks it: where
    some of them are in an <article> or <main>, those outside are no part of it; and an article all of whose runs would
    be fixed, as where all pages of a host are copies, is kept, since vectors can't tell a template from copies there.
    Hosts without a valid class lose nothing but asides.

    Null html gives "" and 0; a null url is a host of its own; repeated rows and null ids keep their rows.
    """
    given = pages.select(F.col(key).alias("k"), F.col(url).alias("u"), F.col(html).alias("h"))

    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, u, h in zip(b["k"].astype("Int64"), b["u"], b["h"]):
                host = xxhash.xxh3_64_intdigest(host_of(u)) - (1 << 63)
                opened = [_TOP]
                texts = [r.token() for r in runs(h, opened) if not r.aside]
                mark = xxhash.xxh3_64_intdigest(f"{k}\0{u}") & 0x3FFFFFFF
                rows += [(host, token, n, mark) for token, n in Counter(opened + texts).items()]
            yield pd.DataFrame(rows, columns=["host", "token", "n", "mark"])

    spread = given.mapInPandas(tokens, "host long, token long, n int, mark long")
    vectors = spread.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("n").alias("total"),
        F.sum(F.col("mark") * F.col("n")).alias("s1"),
        F.sum(F.pmod(F.xxhash64("mark"), F.lit(1 << 30)) * F.col("n")).alias("s2"),
    )
    vectors = store(spark, vectors.where(f"pages >= {support}"), "html-vectors")
    hosts = vectors.where(F.col("token") == _TOP).select("host", F.col("pages").alias("all_pages"))
    classes = vectors.join(hosts, "host").where(F.col("pages") >= F.col("all_pages") * share)
    # Each token with its class of equal vectors. Half the pages share these tokens, so a list has a bound.
    template = classes.select("host", "token", F.xxhash64("pages", "total", "s1", "s2").alias("class")).groupBy("host").agg(
        F.collect_list("token").alias("tokens"), F.collect_list("class").alias("classes")
    )
    template = template.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    @F.pandas_udf("long")
    def host_hash(urls: pd.Series) -> pd.Series:
        return pd.Series([xxhash.xxh3_64_intdigest(host_of(u)) - (1 << 63) for u in urls], dtype="int64")

    @F.pandas_udf("string")
    def main_text(pages_: pd.Series, tokens: pd.Series, classes: pd.Series) -> pd.Series:
        out = []
        for h, t, c in zip(pages_, tokens, classes):
            kept = [r for r in runs(h) if not r.aside]
            slots = kept if t is None else _slots(kept, dict(zip(t.tolist(), c.tolist())))
            inside = [r for r in slots if r.main] or [r for r in kept if r.main]
            out.append(" ".join(r.text for r in inside or slots))
        return pd.Series(out, dtype=object)

    joined = (
        given.withColumn("host", host_hash("u"))
        .withColumn("salt", F.pmod(F.xxhash64("k", "u"), F.lit(SALTS)).cast("int"))
        .join(store(spark, template, "html-template"), ["host", "salt"], "left")
    )
    return joined.select(F.col("k").alias(key), F.col("u").alias(url), main_text("h", "tokens", "classes").alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )
