"""Chat formatting: typed content parts to one string per conversation, and back.

A visitor renders each part by its kind. Text is escaped; image, audio and document parts become
placeholders in their order, and leave an attachment record with the number of tokens that the
placeholder stands for. All of it is column expressions.

Defined results: null texts and roles are empty. Turns go by ``turn`` (null first), ties by role and
text, repeated rows stay. Rows whose ``conv_id`` is null form one conversation. A part of unknown
kind counts as text. An empty table gives no conversation. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
ROLE_BREAK = "<|nl|>"

PART = "struct<kind:string,text:string,ref:string,width:bigint,height:bigint,seconds:double,pages:bigint>"


def escape(text: Column) -> Column:
    """Put one more backslash between ``<`` and ``|``, so that no text holds ``<|``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    """Undo ``escape``."""
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _count(x: Column) -> Column:
    return F.greatest(F.coalesce(x, F.lit(0)), F.lit(0)).cast("bigint")


def _tiles(side: int) -> Callable[[Column], Column]:
    return lambda p: _count(F.ceil(p.width / side) * F.ceil(p.height / side))


@dataclass(frozen=True)
class Media:
    """How a kind of part is shown, and how many tokens it expands to."""

    placeholder: str
    tokens: Callable[[Column], Column]


@dataclass(frozen=True)
class Template:
    """Which roles are trained on, and the rule of each kind that is not text."""

    trained: tuple[str, ...] = ("assistant",)
    media: dict[str, Media] = field(
        default_factory=lambda: {
            "image": Media("<|image|>", _tiles(28)),
            "audio": Media("<|audio|>", lambda p: _count(F.ceil(p.seconds * 25))),
            "document": Media("<|document|>", lambda p: _count(p.pages * 256)),
        }
    )


def as_parts(text: Column) -> Column:
    """One text part."""
    nothing = {"ref": "string", "width": "bigint", "height": "bigint", "seconds": "double", "pages": "bigint"}
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            text.alias("text"),
            *[F.lit(None).cast(kind).alias(name) for name, kind in nothing.items()],
        )
    )


def _visit(parts: Column, template: Template) -> Column:
    """Fold the parts into ``body`` and ``attachments``, whose starts count from the body's start."""

    def rendered(p: Column) -> Column:
        shown = escape(F.coalesce(p.text, F.lit("")))
        for kind, rule in template.media.items():
            shown = F.when(p.kind == kind, F.lit(rule.placeholder)).otherwise(shown)
        return shown

    def tokens(p: Column) -> Column:
        n = F.lit(0).cast("bigint")
        for kind, rule in template.media.items():
            n = F.when(p.kind == kind, rule.tokens(p)).otherwise(n)
        return n

    def step(seen: Column, p: Column) -> Column:
        record = F.struct(
            F.length(seen.body).cast("bigint").alias("start"),
            p.kind.alias("kind"),
            p.ref.alias("ref"),
            tokens(p).alias("tokens"),
        )
        known = F.coalesce(p.kind.isin(*template.media), F.lit(False))
        return F.struct(
            F.concat(seen.body, rendered(p)).alias("body"),
            F.when(known, F.concat(seen.attachments, F.array(record))).otherwise(seen.attachments).alias("attachments"),
        )

    nothing = F.struct(
        F.lit("").alias("body"),
        F.array().cast("array<struct<start:bigint,kind:string,ref:string,tokens:bigint>>").alias("attachments"),
    )
    return F.aggregate(F.coalesce(parts, F.array().cast(f"array<{PART}>")), nothing, step)


def format_chats(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per conversation from ``(conv_id, turn, role, parts)``.

    Returns ``conv_id, n_turns, formatted, loss_spans, attachments, expanded_tokens``. A loss span
    gives the ordinal of its turn, where the turn and the span start in ``formatted``, and the
    span's length, in code points. A conversation is one string, so its turns meet in one row; the
    work within it is linear.
    """
    template = template or Template()
    role = F.coalesce("role", F.lit(""))
    head = F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit(ROLE_BREAK)), F.lit("\n"))
    rows = turns.select(
        "conv_id",
        "turn",
        role.alias("role"),
        head.alias("head"),
        _visit(F.col("parts"), template).alias("seen"),
    ).select("*", F.concat("head", "seen.body", F.lit(END)).alias("segment"))

    order = Window.partitionBy("conv_id").orderBy("turn", "role", "segment")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.select(
        "conv_id",
        (F.row_number().over(order) - 1).cast("bigint").alias("ordinal"),
        F.coalesce(F.sum(F.length("segment").cast("bigint")).over(earlier), F.lit(0).cast("bigint")).alias("turn_start"),
        F.length("head").cast("bigint").alias("head_chars"),
        F.length("seen.body").cast("bigint").alias("length"),
        F.col("role").isin(*template.trained).alias("trained"),
        "segment",
        "seen.attachments",
    ).withColumn("start", F.col("turn_start") + F.col("head_chars"))

    kept = ("ordinal", "turn_start", "start", "length", "trained", "segment", "attachments")
    one = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*kept))).alias("turns"))
    spans = F.transform(
        F.filter("turns", lambda t: t.trained),
        lambda t: F.struct(t.ordinal.alias("ordinal"), t.turn_start.alias("turn_start"), t.start.alias("start"), t.length.alias("length")),
    )
    attached = F.flatten(
        F.transform(
            "turns",
            lambda t: F.transform(
                t.attachments,
                lambda a: F.struct((t.start + a.start).alias("start"), a.kind.alias("kind"), a.ref.alias("ref"), a.tokens.alias("tokens")),
            ),
        )
    )
    return one.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t.segment), "").alias("formatted"),
        spans.alias("loss_spans"),
        attached.alias("attachments"),
    ).withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, a: n + a.tokens))


def read_chats(chats: DataFrame) -> DataFrame:
    """Read ``formatted`` back: add ``turns``, an array of ``(role, text)``, and ``loss_text``.

    ``loss_text`` is the unescaped text under the loss mask, one span after the other.
    """

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        role = F.replace(head.substr(F.lit(len(START) + 1), F.length(head)), F.lit(ROLE_BREAK), F.lit("\n"))
        text = piece.substr(F.length(head) + 2, F.length(piece))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    def covered(span: Column) -> Column:
        piece = F.get("_pieces", span.ordinal.cast("int"))
        return unescape(piece.substr((span.start - span.turn_start + 1).cast("int"), span.length.cast("int")))

    # What follows the last end mark is empty.
    cut = chats.withColumn("_pieces", F.split("formatted", r"<\|im_end\|>\n"))
    return cut.select(
        *chats.columns,
        F.transform(F.slice("_pieces", 1, F.size("_pieces") - 1), turn).alias("turns"),
        F.array_join(F.transform("loss_spans", covered), "").alias("loss_text"),
    )
