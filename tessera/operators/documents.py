"""Scripts, social posts and model replies as rows."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What scene headings begin with, the transitions that also end a scene, and other lines in capitals
#: that are directions, not speakers.
HEADINGS = ("INT", "EXT", "I/E")
TRANSITIONS = ("FADE IN", "FADE OUT", "FADE TO", "CUT TO", "DISSOLVE TO", "SMASH CUT", "MATCH CUT", "BACK TO")
DIRECTIONS = (
    "THE END", "CONTINUED", "CONT'D", "INTERCUT", "MONTAGE", "SUPER", "TITLE", "ANGLE ON", "CLOSE ON", "WIDE", "CLOSE", "INSERT",
    "POV", "V.O", "O.S", "OMITTED", "LATER", "MOMENTS LATER", "PRELAP", "BEAT", "END", "ACT ONE", "ACT TWO", "ACT THREE", "TEASER",
)
_CUE_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 .'-")
SCENE, CUE, OTHER = range(3)


def _begins(line: str, starts: tuple[str, ...], word_ends) -> bool:
    return any(line.startswith(s) and word_ends(line[len(s) : len(s) + 1]) for s in starts)


def line_kind(line: str) -> tuple[int, str]:
    """What a line of a script is, and the speaker that a cue names.

    A cue stands alone in capitals, at most 30 letters and four words, perhaps with a remark in brackets after it."""
    words = line.strip(" \t\r")
    heading = _begins(words, HEADINGS, lambda c: c != "" and c in ". \t/")
    if heading or _begins(words.upper(), TRANSITIONS, lambda c: not (c.isalnum() or c == "_")):
        return SCENE, ""
    name, bracket, remark = words.partition("(")
    if bracket and remark.find(")") != len(remark) - 1:
        return OTHER, ""
    name = name.rstrip(" \t")
    if not name[:1].isalpha() or not _CUE_LETTERS.issuperset(name) or len(name) > 31 or len(line) - len(line.lstrip(" \t")) > 20:
        return OTHER, ""
    name = name.strip(" .-")
    known = name in HEADINGS or name in TRANSITIONS or name in DIRECTIONS or _begins(name, HEADINGS, lambda c: not (c.isalnum() or c == "_"))
    if not name or known or " - " in name or "--" in name or len(name) > 30 or len(name.split()) > 4:
        return OTHER, ""
    return CUE, name.title()


def script_scenes(text: str, least_scenes: int = 2, least_cues: int = 4) -> list[list[str]]:
    """The speakers of each scene, in order; nothing for texts that don't look like scripts."""
    found: list[dict[str, None]] = [{}]
    for kind, name in map(line_kind, text.split("\n")):
        if kind == SCENE:
            found.append({})
        elif kind == CUE:
            found[-1][name] = None
    if len(found) - 1 < least_scenes or len({s for scene in found for s in scene}) < least_cues:
        return []
    return [list(scene) for scene in found if scene]


def scenes(docs: DataFrame) -> DataFrame:
    """(doc_id, scene_id, speaker) of docs (doc_id, text)."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            rows = [(d, i, s) for d, t in zip(part["doc_id"], part["text"].fillna(""), strict=True) for i, scene in enumerate(script_scenes(t)) for s in scene]
            yield pd.DataFrame(rows, columns=["doc_id", "scene_id", "speaker"])

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, scene_id int, speaker string")


def with_parents(posts: DataFrame) -> DataFrame:
    """posts (post_id, parent_id, author) with parent_author from the same batch."""
    authors = posts.select(F.col("post_id").alias("parent_id"), F.col("author").alias("_a")).dropDuplicates(["parent_id"])
    return posts.join(authors, "parent_id", "left").withColumn("parent_author", F.coalesce(F.col("parent_author") if "parent_author" in posts.columns else F.lit(None), F.col("_a"))).drop("_a")


def social_edges(posts: DataFrame) -> DataFrame:
    """(source, target, rel_type, doc_id): replies, communities, forwards and mentions; never to oneself.

    posts: doc_id, author, parent_author, community, forwarded_from, mentions."""
    one = lambda target, rel: posts.select(F.col("author").alias("source"), target.alias("target"), F.lit(rel).alias("rel_type"), "doc_id")
    made = one(F.col("parent_author"), "replied_to").union(one(F.col("community"), "posted_in")).union(one(F.col("forwarded_from"), "forwarded_from")).union(one(F.explode_outer("mentions"), "mentions"))
    return made.filter("coalesce(source, '') <> '' AND coalesce(target, '') <> '' AND lower(source) <> lower(target)").distinct()


def comment_tree(roots: DataFrame) -> DataFrame:
    """(post_id, parent_id, author, text, level) of nested replies: roots hold JSON in ``data``, replies in ``replies``,
    however deep."""

    def walk(node: dict, parent: str | None, level: int) -> Iterator[tuple]:
        stack = [(node, parent, level)]
        while stack:
            item, above, at = stack.pop()
            if not isinstance(item, dict):
                continue
            yield item.get("id"), above, item.get("author"), item.get("body") or item.get("text"), at
            stack += [(r, item.get("id"), at + 1) for r in item.get("replies") or []]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            rows = [r for raw in part["data"] for r in walk(json.loads(repair_json(raw) or "{}"), None, 0)]
            yield pd.DataFrame(rows, columns=["post_id", "parent_id", "author", "text", "level"])

    return roots.select("data").mapInPandas(run, "post_id string, parent_id string, author string, text string, level int")


def repair_json(raw: str | None) -> str | None:
    """A reply's JSON object or list made parseable: fences and prose off, quotes straight, commas mended, words of
    other languages replaced, open ends closed.  Null if nothing helps."""
    if not raw:
        return None
    fenced = re.findall(r"```(?:json)?\s*(.*?)```", raw, re.S)
    tries = [*reversed(fenced), raw]
    for text in tries:
        start = min((i for i in (text.find("{"), text.find("[")) if i >= 0), default=-1)
        if start < 0:
            continue
        body = text[start:]
        end = max(body.rfind("}"), body.rfind("]"))
        for candidate in (body[: end + 1], body):
            for mend in (lambda s: s, _mend, lambda s: _close(_mend(s))):
                fixed = mend(candidate)
                try:
                    json.loads(fixed)
                    return fixed
                except ValueError:
                    continue
    return None


def _mend(text: str) -> str:
    text = text.replace("“", '"').replace("”", '"').replace("’", "'")
    text = re.sub(r"//[^\n]*|/\*.*?\*/", "", text, flags=re.S) if '"//' not in text and "://" not in text else text
    text = re.sub(r"\bNone\b", "null", re.sub(r"\bTrue\b", "true", re.sub(r"\bFalse\b", "false", text)))
    text = re.sub(r'("|\d|\]|\}|true|false|null)\s*\n\s*(")', r"\1,\n\2", text)
    text = re.sub(r"([}\]])\s*([{\[])", r"\1,\2", text)
    text = re.sub(r'([{,]\s*)([A-Za-z_]\w*)(\s*:)', r'\1"\2"\3', text)
    text = re.sub(r",(\s*,)+", ",", text)
    return re.sub(r",\s*([}\]])", r"\1", text)


def _close(text: str) -> str:
    """Close what is left open, after the last whole value."""
    stack, quoted, skip = [], False, False
    for c in text:
        if skip:
            skip = False
        elif c == "\\":
            skip = quoted
        elif c == '"':
            quoted = not quoted
        elif not quoted and c in "{[":
            stack.append("}" if c == "{" else "]")
        elif not quoted and c in "}]" and stack:
            stack.pop()
    text = text + '"' if quoted else text
    text = re.sub(r'[,\s]+$', "", text)
    text = re.sub(r',?\s*"[^"]*"\s*:\s*$', "", text)
    return text + "".join(reversed(stack))


def pack_batches(docs: DataFrame, most_chars: int, most_docs: int) -> DataFrame:
    """(doc_id, batch): documents in order, a new batch where the next would exceed the characters or the number.

    The order decides, so it runs per ``shard`` of docs (shard, doc_id, n_chars), a partition each."""

    def fill(part: pd.DataFrame) -> pd.DataFrame:
        number, chars, count, out = 0, 0, 0, []
        for n in part.sort_values("doc_id")["n_chars"]:
            if count and (chars + n > most_chars or count >= most_docs):
                number, chars, count = number + 1, 0, 0
            chars, count = chars + n, count + 1
            out.append(number)
        return pd.DataFrame({"shard": part["shard"], "doc_id": sorted(part["doc_id"]), "batch": out})

    kinds = dict(docs.dtypes)
    return docs.select("shard", "doc_id", "n_chars").groupBy("shard").applyInPandas(fill, f"shard {kinds['shard']}, doc_id {kinds['doc_id']}, batch int")
