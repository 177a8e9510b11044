"""Hashes, text assembly and default chains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEGACY_TEXT_LIMIT = 5000
CONTEXT_LIMIT = 500
PREVIEW_LIMIT = 250


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def url_hash(url: Column | str) -> Column:
    """Canonical identity of an article: hex sha-256 of the lower-cased, space-trimmed url."""
    return F.sha2(F.lower(F.trim(_col(url))), 256)


def message_key(url: Column | str) -> Column:
    """Key of an outgoing message: hex sha-256 of the url as it came."""
    return F.sha2(_col(url), 256)


def joined_hash(*parts: Column | str) -> Column:
    """Hex sha-256 of the parts joined with ``|``; a null part counts as empty text."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts]), 256)


def event_id(provider: Column | str, url: Column | str, published_at: Column | str) -> Column:
    return joined_hash(provider, url, published_at)


def raw_article_text(title: Column | str, description: Column | str, content: Column | str) -> Column:
    """Three text fields separated by one space each, nulls as empty text, nothing stripped."""
    return F.concat_ws(" ", *[F.coalesce(_col(c), F.lit("")) for c in (title, description, content)])


def article_text(title: Column | str, description: Column | str, content: Column | str) -> Column:
    return F.trim(raw_article_text(title, description, content))


def mention_context(title: Column | str, description: Column | str, content: Column | str) -> Column:
    """Leading part of the unstripped text kept beside a mention, for people to read."""
    return F.left(raw_article_text(title, description, content), F.lit(CONTEXT_LIMIT))


def title_preview(text: Column | str, length: int = PREVIEW_LIMIT) -> Column:
    return F.left(_col(text), F.lit(length))


def first_nonblank(*choices: Column | str, default: str | None = None) -> Column:
    """First choice that is neither null nor empty text, else the default."""
    tried = [F.nullif(_col(c), F.lit("")) for c in choices]
    return F.coalesce(*tried, F.lit(default))


def nonblank(text: Column | str) -> Column:
    return F.trim(_col(text)) != ""


def strip_all(text: Column | str) -> Column:
    """Strip every kind of white space at both ends, where ``trim`` takes spaces only."""
    return F.regexp_replace(_col(text), r"^\s+|\s+$", "")


def raw_variant(json_text: Column | str) -> Column:
    """JSON text as a variant value; null where it is not JSON."""
    return F.try_parse_json(_col(json_text))
