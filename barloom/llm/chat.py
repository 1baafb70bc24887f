"""Chat formatting: records of different layouts to canonical turns and marked text.

A record is a JSON text. Its nested field paths, without the types of the values, are
hashed; the hash selects one of the declared mappings, which says where the turns are.
The template writes every turn between control strings, which are escaped inside roles and
texts so that reading back gives the turns exactly. The loss mask is a list of runs, one a
turn: characters to skip and characters to keep.

Defined results: a null text or role is empty; a record of an undeclared layout has null
turns and null text, and can be filtered on ``turns is null``, and so has a null record, one
that is no JSON and one that is too large for a variant (over 128 MB); a conversation without
rows does not exist. Rows without identifier are one conversation. Turns with equal numbers are ordered by role and text. A conversation is
one row of the result, so all its turns must fit into a row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, TAIL = "### ", "</turn>\n"
# Fixed order: the escape character first. A line end only matters inside a role.
ESCAPES = (("\\", "\\0"), ("</turn>", "\\1"), ("### ", "\\2"))
LINE_END = ("\n", "\\3")
LOSS_ROLE = "assistant"


@dataclass(frozen=True)
class Fields:
    """A layout with one field for each turn: role, field name."""

    turns: tuple[tuple[str, str], ...]

    @property
    def paths(self) -> str:
        return f"OBJECT<{', '.join(sorted(name for _, name in self.turns))}>"

    def read(self, record: Column) -> Column:
        return F.array(
            *[_turn(F.lit(role), F.variant_get(record, f"$.{name}", "string"))
              for role, name in self.turns]
        )


@dataclass(frozen=True)
class Messages:
    """A layout with a list of messages; ``names`` translates its roles."""

    key: str
    role: str
    text: str
    names: tuple[tuple[str, str], ...] = ()

    @property
    def paths(self) -> str:
        fields = ", ".join(sorted((self.role, self.text)))
        return f"OBJECT<{self.key}: ARRAY<OBJECT<{fields}>>>"

    def read(self, record: Column) -> Column:
        kind = f"array<struct<{self.role}:string,{self.text}:string>>"
        items = F.variant_get(record, f"$.{self.key}", kind)

        def role(x: Column) -> Column:
            out = x[self.role]
            for given, canonical in self.names:
                out = F.when(x[self.role] == given, F.lit(canonical)).otherwise(out)
            return out

        return F.transform(items, lambda x: _turn(role(x), x[self.text]))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")
    )


LAYOUTS: tuple[Fields | Messages, ...] = (
    Fields((("user", "prompt"), ("assistant", "completion"))),
    Fields((("user", "prompt"), ("assistant", "response"))),
    Fields((("user", "question"), ("assistant", "answer"))),
    Fields((("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    Fields((("user", "instruction"), ("assistant", "output"))),
    Messages("messages", "role", "content"),
    Messages("turns", "role", "text"),
    Messages(
        "conversations", "from", "value", (("human", "user"), ("gpt", "assistant"))
    ),
)


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a variant, whatever the types of its values."""
    paths = F.regexp_replace(F.schema_of_variant(record), r": [A-Z]+(\([0-9,]+\))?(?=[,>])", "")
    return F.xxhash64(paths)


def canonical_turns(record: Column) -> Column:
    """array<struct<role, text>> by the mapping that the fingerprint selects, else null."""
    print_ = fingerprint(record)
    turns = F.lit(None)
    for layout in LAYOUTS:
        turns = F.when(print_ == F.xxhash64(F.lit(layout.paths)), layout.read(record)).otherwise(
            turns
        )
    return turns


def _escaped(text: Column, role: bool = False) -> Column:
    for plain, code in (*ESCAPES, LINE_END) if role else ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def _plain(text: Column) -> Column:
    for plain, code in reversed((*ESCAPES, LINE_END)):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_chat(records: DataFrame, column: str = "record") -> DataFrame:
    """The records with ``turns``, the marked ``formatted`` text and its ``loss_mask``."""
    kept = [c for c in records.columns if c not in ("turns", "formatted", "loss_mask")]
    parsed = records.withColumn("_variant", F.try_parse_json(column))
    # Two steps, or the mapping would run once for each use of the turns.
    turns = parsed.select(*kept, canonical_turns(F.col("_variant")).alias("turns"))
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(HEAD), _escaped(t["role"], True), F.lit("\n")).alias("head"),
            _escaped(t["text"]).alias("body"),
            (t["role"] == LOSS_ROLE).alias("loss"),
        ),
    )
    split = turns.select(*kept, "turns", parts.alias("_parts"))
    formatted = F.array_join(
        F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit(TAIL))), ""
    )
    mask = F.transform(
        "_parts",
        lambda p, i: F.struct(
            (
                F.when(i > 0, len(TAIL)).otherwise(0)
                + F.length(p["head"])
                + F.when(p["loss"], 0).otherwise(F.length(p["body"]))
            ).alias("skip"),
            F.when(p["loss"], F.length(p["body"])).otherwise(0).alias("keep"),
        ),
    )
    return split.select(*kept, "turns", formatted.alias("formatted"), mask.alias("loss_mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``read_turns`` and ``read_loss`` (the texts under the mask) from the output alone."""
    kept = [c for c in formatted.columns if c not in ("read_turns", "read_loss")]
    pieces = F.split("formatted", F.lit(TAIL))
    cut = formatted.select(*kept, F.slice(pieces, 1, F.size(pieces) - 1).alias("_cut"))

    def turn(piece: Column) -> Column:
        end = F.instr(piece, "\n")
        return F.struct(
            _plain(F.substring(piece, F.lit(len(HEAD) + 1), end - len(HEAD) - 1)).alias("role"),
            _plain(F.substring(piece, end + 1, F.length(piece))).alias("text"),
        )

    under = F.zip_with(
        F.col("_cut"),
        F.transform(
            "loss_mask",
            lambda m, i: F.struct(
                (m["skip"] - F.when(i > 0, len(TAIL)).otherwise(0)).alias("skip"),
                m["keep"].alias("keep"),
            ),
        ),
        lambda piece, m: _plain(F.substring(piece, m["skip"] + 1, m["keep"])),
    )
    return cut.select(
        *kept,
        F.transform("_cut", turn).alias("read_turns"),
        F.array_join(under, "").alias("read_loss"),
    )


def chat_records(rows: DataFrame) -> DataFrame:
    """conv_id, record: rows (conv_id, turn, role, text) as JSON in the fitting layout.

    A user and an assistant turn become a prompt record, a system turn before them an
    instruction record, anything else a list of messages.
    """
    turns = F.sort_array(
        F.collect_list(
            F.struct(
                "turn",
                F.coalesce("role", F.lit("")).alias("role"),
                F.coalesce("text", F.lit("")).alias("text"),
            )
        )
    )
    grouped = rows.groupBy("conv_id").agg(turns.alias("_turns"))
    roles = grouped.select("conv_id", "_turns", F.col("_turns.role").alias("_roles"))

    def text(i: int) -> Column:
        return F.get("_turns", F.lit(i))["text"]

    def is_(*names: str) -> Column:
        return F.col("_roles") == F.array(*[F.lit(n) for n in names])

    messages = F.transform(
        "_turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))
    )
    record = (
        F.when(
            is_("user", "assistant"),
            F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion"))),
        )
        .when(
            is_("system", "user", "assistant"),
            F.to_json(
                F.struct(
                    text(0).alias("instruction"), text(1).alias("input"), text(2).alias("output")
                )
            ),
        )
        .otherwise(F.to_json(F.struct(messages.alias("messages"))))
    )
    return roles.select("conv_id", record.alias("record"))


def chat_digests(rows: DataFrame) -> DataFrame:
    """One row a conversation, every value read back from the formatted text and its mask."""
    back = read_back(format_chat(chat_records(rows)))
    joined = F.array_join(
        F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))),
        "",
    )
    return back.select(
        "conv_id",
        F.size("read_turns").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.length("read_loss").cast("long").alias("loss_chars"),
        F.sha2("read_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
