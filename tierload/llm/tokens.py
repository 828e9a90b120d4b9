"""Token counts of whole texts under a public tokenizer.

Arrow functions return lengths only; texts are taken in batches of about
equal bytes.  For byte-level BPE with the standard pre-tokenizer, a text
is cut at boundaries where the pre-tokenizer always cuts too:

* before one space that a certainly visible character follows (a run of
  white space gives its last space to the next word), and
* around a single newline between two certainly visible characters,
* between a letter and one final punctuation mark of such a piece.

The pieces are encoded by the tokenizer library itself and short ones are
remembered, so a piece that occurs again is not encoded again; a piece of
letters only goes straight to the library's BPE model.  Added
tokens are matched before pre-tokenisation; the cut is only used when
none of them holds a space or newline or strips white space around it.
A text with other white space is cut at the first kind of boundary only,
every ``PIECE_CHARS`` or so.  Any other tokenizer encodes texts whole.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated
rows are counted each; an empty table gives an empty result; only the id
and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierload.llm.common import worker_state
from tierload.llm.text import blocks

PIECE_CHARS = 32_768
CACHED_PIECES = 800_000
CACHED_CHARS = 40
#: characters that are certainly not white space: ASCII graphic, and Latin letters
_VISIBLE = "!-~À-ɏ"
_CUT = re.compile(f"(?= [{_VISIBLE}])")
_STARTS = re.compile(f"[{_VISIBLE}]").match
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: letters alone: the pre-tokenizer keeps such a piece in one part
_ONE_WORD = re.compile(f"[{_LETTERS}]+$").match
#: one of these marks after a letter begins a piece of its own
_MARKS = ".,;:!?"
_MARK_AFTER_LETTER = re.compile(f"[^ \\n]*[{_LETTERS}][{_MARKS}]$").match


class _Uncut(Exception):
    """A piece does not begin at a safe boundary."""


class PieceCounter:
    """Token counts from safe pieces, remembered per piece."""

    def __init__(self, encode: Callable[[list[str]], list[int]], one_word: Callable[[str], int]) -> None:
        self.encode = encode
        self.after_space, self.at_start = _Pieces(encode, one_word, " "), _Pieces(encode, one_word, "")
        self.newline = encode(["\n"])[0]

    def count(self, text: str) -> int:
        if not text:
            return 0
        try:
            return self._by_pieces(text)
        except _Uncut:
            return sum(self.encode(list(long_pieces(text))))

    def _by_pieces(self, text: str) -> int:
        lines = text.split("\n")
        total = self.newline * (len(lines) - 1)
        first, rest = self.at_start, self.after_space
        many = len(lines) > 1
        for line in lines:
            words = line.split(" ")
            if many and not (line and _STARTS(line[-1])):
                raise _Uncut
            total += first[words[0]]
            del words[0]
            total += sum(map(rest.__getitem__, words))
        return total


class _Pieces(dict):
    def __init__(self, encode: Callable[[list[str]], list[int]], one_word: Callable[[str], int], lead: str) -> None:
        super().__init__()
        self.encode, self.one_word, self.lead = encode, one_word, lead
        self.marks = dict(zip(_MARKS, encode(list(_MARKS)), strict=True))

    def __missing__(self, piece: str) -> int:
        if not _STARTS(piece):
            raise _Uncut
        if _ONE_WORD(piece):
            n = self.one_word(self.lead + piece)
        elif _MARK_AFTER_LETTER(piece):
            n = self[piece[:-1]] + self.marks[piece[-1]]
        else:
            n = self.encode([self.lead + piece])[0]
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = n
        return n


def long_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Parts of about ``size`` characters, cut at safe boundaries (longer where there is none)."""
    begin = 0
    while len(text) - begin > size:
        cut = _CUT.search(text, begin + size)
        if cut is None:
            break
        yield text[begin:cut.start()]
        begin = cut.start()
    yield text[begin:]


def is_safe_byte_bpe(spec: dict) -> bool:
    """The tokenizer cuts texts as ``PieceCounter`` assumes."""
    pre = spec.get("pre_tokenizer") or {}
    added = spec.get("added_tokens") or []
    return (spec.get("normalizer") is None and not spec.get("truncation") and not spec.get("padding")
            and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and spec.get("model", {}).get("type") == "BPE"
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"])
                        for t in added))


def counter(name: str, content: bytes) -> Callable[[list[str]], list[int]]:
    """Function from texts to token counts, for a .json or .model vocabulary."""
    if name.endswith(".json"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        tok = Tokenizer.from_str(content.decode("utf-8"))
        tok.no_padding()
        tok.no_truncation()

        def encode(texts: list[str]) -> list[int]:
            return [len(e) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

        if not is_safe_byte_bpe(json.loads(content)):
            return encode
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        letters = {c: as_bytes(chr(c))[0][0] for c in (32, *range(0xC0, 0x250))}
        model = tok.model
        pieces = PieceCounter(encode, lambda word: len(model.tokenize(word.translate(letters))))
        return lambda texts: [pieces.count(t) for t in texts]
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_proto=content)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    raise ValueError(f"unknown kind of vocabulary file: {name}")


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every text: one narrow pass.

    ``vocabulary``: path of a tokenizer file on the driver; its content (a few MB) travels with the tasks.
    """
    with open(vocabulary, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    name = os.path.basename(vocabulary)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in batches:
            for b in blocks(batch, "text"):
                count = count or worker_state(("tokens", name, hash(content.value)), lambda: counter(name, content.value))
                texts = pc.fill_null(b.column("text"), "")
                n = pa.array(count(texts.to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pc.binary_length(texts).cast(pa.int64()), n], ["id", "n_bytes", "n_tokens"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)
