"""Chat formatting with typed content parts.

A turn is a list of parts: text, image, audio or document. A visitor flattens them, in
order, into text with placeholders, and records for every attachment its reference,
where its placeholder stands and how many tokens it will expand to. The template marks
turns; control strings inside texts are escaped and can be read back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meseta.llm.common import arrow_map, arrow_stream
from meseta.llm.registry import query, table

# What a text must not contain unescaped. The first four are this template's
# own; the others are those of common templates, kept out so that no reader takes them for one.
TURN, BODY, END, SLOT = "<|turn|>", "<|body|>", "<|end|>", "<|slot|>"
CONTROLS = (TURN, BODY, END, SLOT, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(
    re.escape(TURN) + r"(.*?)" + re.escape(BODY) + r"(.*?)" + re.escape(END) + "\n", re.DOTALL)


def escape(text: str) -> str:
    r"""Double every backslash, then put one behind the first character of each control string."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass
class Attachment:
    kind: str
    ref: str
    at: int  # code point of its placeholder in the turn's body
    tokens: int


@dataclass
class Flattener:
    """Visits the parts of a turn in order; ``body`` is the text with placeholders."""

    tile: int = 28  # pixels of an image that make one token, on each side
    audio_rate: float = 25.0  # tokens of a second
    page_tokens: int = 512  # tokens of a page without parts of its own
    body: str = ""
    attachments: list[Attachment] = field(default_factory=list)
    pending: str = ""  # text not yet escaped: a control string can span two parts

    def flatten(self, parts: list[dict]) -> Flattener:
        for part in parts:
            self.visit(part)
        self._flush()
        return self

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('type') or 'text'}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> None:
        self.pending += part.get("text") or ""

    def visit_image(self, part: dict) -> None:
        wide, high = (-(-int(part.get(side) or 0) // self.tile) for side in ("width", "height"))
        self._attach("image", part, max(wide * high, 1))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, max(-(-float(part.get("seconds") or 0) * self.audio_rate // 1), 1))

    def visit_document(self, part: dict) -> None:
        """A document is its pages; parts inside it follow its placeholder in order."""
        inner = part.get("parts") or []
        self._attach("document", part, 0 if inner else max(int(part.get("pages") or 0), 1) * self.page_tokens)
        for child in inner:
            self.visit(child)

    def visit_unknown(self, part: dict) -> None:
        self._attach(str(part.get("type")), part, 1)

    def _attach(self, kind: str, part: dict, tokens: float) -> None:
        self._flush()
        ref = part.get("ref") or ""
        self.attachments.append(Attachment(kind, ref, len(self.body), int(tokens)))
        self.body += f"{SLOT}{escape(kind)}:{len(self.attachments) - 1}{SLOT}"

    def _flush(self) -> None:
        self.body, self.pending = self.body + escape(self.pending), ""


def format_turn(role: str, body: str) -> str:
    """One turn; ``body`` is escaped already."""
    return f"{TURN}{escape(role)}{BODY}{body}{END}\n"


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, body) of every turn of a formatted text; bodies are still escaped."""
    return [(unescape(m[1]), m[2]) for m in _TURN.finditer(text)]




def format_turns(turns: DataFrame) -> DataFrame:
    """conv, turn, formatted, loss_from, loss_to, attachments from conv, turn, role, parts.

    Each row is formatted alone, so a conversation of any length is spread over tasks;
    joined by turn, the rows are the conversation. The loss covers the body of assistant
    turns: code points loss_from to loss_to of the row, empty for other roles. A null
    role is an empty role, null parts are no parts and a null text is empty.
    """

    def render(batch: pa.RecordBatch) -> Iterator[dict]:
        formatted, loss_from, loss_to, attachments = [], [], [], []
        for role, parts in zip(batch.column("role").to_pylist(), batch.column("parts").to_pylist()):
            flat = Flattener().flatten([part or {} for part in parts or []])
            text = format_turn(role or "", flat.body)
            start = len(TURN) + len(escape(role or "")) + len(BODY)
            formatted.append(text)
            loss_from.append(start)
            loss_to.append(start + len(flat.body) if role == "assistant" else start)
            attachments.append([vars(a) for a in flat.attachments])
        yield {
            "conv": batch.column("conv"), "turn": batch.column("turn"), "formatted": formatted,
            "loss_from": loss_from, "loss_to": loss_to, "attachments": attachments}

    kinds = dict(turns.dtypes)
    return arrow_map(
        turns.select("conv", "turn", "role", "parts"), render,
        f"conv {kinds['conv']}, turn {kinds['turn']}, formatted string, loss_from long, loss_to long, "
        "attachments array<struct<kind:string,ref:string,at:long,tokens:long>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, read from the formatted rows: conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Rows arrive sorted and only the digests in progress are held, so a conversation with
    very many turns needs no more memory than one turn. Turns that repeat a number are
    ordered by their text; a null number comes first, and null is a conversation.
    """
    kinds = dict(formatted.dtypes)
    rows = formatted.repartition("conv").sortWithinPartitions("conv", "turn", "formatted", "loss_to")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        done: list[tuple] = []
        now, state = None, None

        def close() -> None:
            if state:
                done.append((now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            for conv, text, low, high in zip(*(
                    batch.column(name).to_pylist() for name in ("conv", "formatted", "loss_from", "loss_to"))):
                if state is None or conv != now:
                    close()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in read_turns(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{unescape(body)}\n".encode())
                masked = unescape(text[low:high])
                state[2] += len(masked)
                state[3].update(masked.encode())
                state[4] += len(text)
            if len(done) > 10_000:
                yield dict(zip(_READ, zip(*done)))
                done = []
        close()
        if done:
            yield dict(zip(_READ, zip(*done)))

    return arrow_stream(
        rows.select("conv", "formatted", "loss_from", "loss_to"), read,
        f"conv {kinds['conv']}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long")


_READ = ("conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")

_SAID = "</s>[INST] ok [/INST]"
_LENGTH = "length(t) + length(t) - length(replace(t, chr(92), ''))" + "".join(
    f" + (length(t) - length(replace(t, '{c}', ''))) // {len(c)}" for c in CONTROLS)


@query("op4_chat_format", sql=f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_SAID}' UNION ALL SELECT -7, 1, 'assistant', '{_SAID}'),
m AS (SELECT *, {_LENGTH} AS n, CASE WHEN role = 'assistant' THEN t ELSE '' END AS loss FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
  CAST(sum(length(loss)) AS BIGINT) AS loss_chars, sha256(string_agg(loss, '' ORDER BY turn, role, t)) AS loss_sha256,
  CAST(sum(n + length(role) + {len(TURN + BODY + END) + 1}) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id""")
def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", _SAID), (-7, 1, "assistant", _SAID)], turns.schema)
    part = F.struct(
        F.lit("text").alias("type"), "text",
        *[F.lit(None).cast(kind).alias(name) for name, kind in (
            ("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))])
    typed = turns.unionByName(extra).select(
        F.col("conv_id").alias("conv"), "turn", "role", F.array(part).alias("parts"))
    return read_back(format_turns(typed)).withColumnRenamed("conv", "conv_id")
