"""Chat formatting by incremental black-box rendering.

A template is any object with `render(messages) -> str` (messages: (role, text) pairs), `texts_in(text) -> str` (how it
writes a text) and `read(output) -> messages`.  The formatter knows nothing else of it: it renders successive turn
prefixes, compares consecutive outputs to locate each turn's span, renders the last turn with two fillers to locate the
text inside the span, and reports templates that rewrite history (an output that does not extend the one before).

Edge cases: a null text or role is an empty one; turns that tie are put in order of role and text, repeated rows stay
repeated turns; an empty text has an empty span.  Of a template that rewrites history no spans are given (`rewrites` is
true, the loss mask is empty).  A conversation is rendered in segments of SEGMENT turns, which bounds the cost of the prefixes; its digests are carried over segments.  Each later segment is rendered after the CONTEXT turns
before it, whose output is taken off, so that what a template writes only before a first turn comes once, and a turn
that rewrites the one before it is found at a segment's start too.  At the ends of 2, 4, 8 ... segments and of the conversation
all turns so far are rendered; where that is not what the segments gave, the template looks further back, and the whole
conversation is rendered as one segment.  So a conversation's turns are held, and rendering them is linear unless a template looks back.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import text_or_empty, tune

SEGMENT = 128
CONTEXT = 2
CONTROL = ("<<ROLE>>", "<</ROLE>>", "[INST]", "[/INST]", "<s>", "</s>")
_FIND = re.compile("|".join(map(re.escape, ("\\", *CONTROL))))
_BACK = re.compile(r"\\([\\!])")
_TURN = re.compile(r"\[INST\] (?:<<ROLE>>(.*?)<</ROLE>> )?(.*?) \[/INST\]|<s> (.*?) </s>", re.S)


def escape(text: str) -> str:
    """Backslashes are doubled and a control string is split by a backslash and `!` after its first character."""
    return _FIND.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\!{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _BACK.sub(lambda m: "\\" if m[1] == "\\" else "", text)


class InstTemplate:
    """[INST] user [/INST]<s> assistant </s>; other roles carry their name."""

    def render(self, messages: list[tuple[str, str]]) -> str:
        out = []
        for role, text in messages:
            if role == "assistant":
                out.append(f"<s> {escape(text)} </s>")
            else:
                out.append(f"[INST] {'' if role == 'user' else f'<<ROLE>>{escape(role)}<</ROLE>> '}{escape(text)} [/INST]")
        return "".join(out)

    def read(self, output: str) -> list[tuple[str, str]]:
        found, at = [], 0
        while at < len(output):
            m = _TURN.match(output, at)
            if not m:
                raise ValueError(f"no turn at {at}")
            found.append(("assistant", unescape(m[3])) if m[3] is not None else ("user" if m[1] is None else unescape(m[1]), unescape(m[2])))
            at = m.end()
        return found

    def texts_in(self, written: str) -> str:
        return unescape(written)


def locate(template, messages: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]], list[tuple[int, int] | None], bool]:
    """(output, span of each turn, span of the text in assistants' turns, whether history was rewritten)."""
    before, spans, texts = "", [], []
    for k, (role, _) in enumerate(messages):
        now = template.render(messages[: k + 1])
        if not now.startswith(before):
            return template.render(messages), [], [], True
        spans.append((len(before), len(now)))
        text = None
        if role == "assistant":
            a, b = (template.render([*messages[:k], (role, x)]) for x in ("A", "B"))
            start = len(os.path.commonprefix([a, b]))
            text = start, len(now) - (len(a) - start - 1)
        texts.append(text)
        before = now
    return before, spans, texts, False


SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_segments long, rewrites boolean, formatted array<string>, loss_spans array<array<int>>"


def _format(template, with_text: bool):
    fields = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_segments", pa.int64()), ("rewrites", pa.bool_()), ("formatted", pa.list_(pa.string())), ("loss_spans", pa.list_(pa.list_(pa.int32())))])

    def conversation(key, turns: Iterator[tuple[str, str]]):
        n = chars = loss_chars = segments = 0
        said, lost = hashlib.sha256(), hashlib.sha256()
        rewrote, kept, kept_spans, context, written = False, [], [], [], hashlib.sha256()

        def segment(messages):
            nonlocal n, chars, loss_chars, segments, rewrote, context
            output, _, texts, again = locate(template, [*context, *messages])
            rewrote |= again
            base, texts = len(template.render(context)) if context else 0, texts[len(context) :]
            for role, text in template.read(output)[len(context) :]:
                said.update(f"{role}\n{text}\n".encode())
                n += 1
            flat = []
            for span in texts:
                if span:
                    text = template.texts_in(output[span[0] : span[1]])
                    lost.update(text.encode())
                    loss_chars += len(text)
                    flat += span[0] - base, span[1] - base
            chars += len(output) - base
            written.update(output[base:].encode("utf-8", "surrogatepass"))
            segments += 1
            context = messages[-CONTEXT:]
            if with_text:
                kept.append(output[base:])
                kept_spans.append(flat)

        def differs():
            return rewrote or written.digest() != hashlib.sha256(template.render(said_so_far).encode("utf-8", "surrogatepass")).digest()

        said_so_far, done, again = [], 0, False
        for turn in turns:
            said_so_far.append(turn)
            if len(said_so_far) - done == SEGMENT and not again:
                segment(said_so_far[done:])
                done = len(said_so_far)
                again = segments > 1 and segments & (segments - 1) == 0 and differs()
        if done < len(said_so_far) and not again:
            segment(said_so_far[done:])
        if again or (segments > 1 and differs()):  # the template looks further back than a segment
            n = chars = loss_chars = segments = 0
            said, lost = hashlib.sha256(), hashlib.sha256()
            rewrote, kept, kept_spans, context = False, [], [], []
            segment(said_so_far)
        return key, n, said.hexdigest(), loss_chars, lost.hexdigest(), chars, segments, rewrote, kept if with_text else None, kept_spans if with_text else None

    def run(batches):
        rows = []
        each = (r for b in batches for r in zip(*(b.column(k).to_pylist() for k in ("conv_id", "role", "text")), strict=True))
        for key, turns in itertools.groupby(each, lambda r: r[0]):  # turns are streamed, a segment is held
            rows.append(conversation(key, (r[1:] for r in turns)))
            if len(rows) >= 500:
                yield pa.RecordBatch.from_pylist([dict(zip(fields.names, r, strict=True)) for r in rows], fields)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(fields.names, r, strict=True)) for r in rows], fields)

    return run


def format_conversations(turns: DataFrame, template=None, with_text: bool = True) -> DataFrame:
    """One row per conversation, read back from its rendered output.  Rows without conv_id are one conversation, of id null."""
    tune(turns.sparkSession)
    lean = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), text_or_empty("role").alias("role"), text_or_empty("text").alias("text"))
    dealt = lean.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(_format(template or InstTemplate(), with_text), SCHEMA)
