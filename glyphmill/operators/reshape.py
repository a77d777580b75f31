"""Samples in the three training layouts: flat rows, chat messages, instruction JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.functions.text import collapse, language_of_key

IMAGE_TYPE = "struct<bytes:binary,path:string>"
PART_TYPE = f"struct<image:{IMAGE_TYPE},text:string,type:string>"
MESSAGES_TYPE = f"array<struct<content:array<{PART_TYPE}>,role:string>>"


def image_struct(content: Column, path: Column) -> Column:
    return F.struct(content.alias("bytes"), path.alias("path"))


def flat_sample(df: DataFrame, *keep: str) -> DataFrame:
    """``id, language, text, image`` from ``basename, text, image``; language from the name."""
    return df.select(
        F.col("basename").alias("id"),
        language_of_key(F.col("basename")).alias("language"),
        collapse(F.col("text")).alias("text"),
        "image",
        *keep,
    )


def chat_messages(text: Column, image: Column, instruction: str = "OCR:") -> Column:
    """A user turn (instruction, image) and an assistant turn (the text).

    Parts not used are null, so every part has the same three fields.
    """

    def part(kind: str, words: Column, picture: Column) -> Column:
        return F.struct(picture.alias("image"), words.alias("text"), F.lit(kind).alias("type"))

    nothing = F.lit(None)
    user = F.array(
        part("text", F.lit(instruction), nothing.cast(IMAGE_TYPE)),
        part("image", nothing.cast("string"), image.cast(IMAGE_TYPE)),
    )
    assistant = F.array(part("text", text, nothing.cast(IMAGE_TYPE)))

    def turn(content: Column, role: str) -> Column:
        return F.struct(content.alias("content"), F.lit(role).alias("role"))

    return F.array(turn(user, "user"), turn(assistant, "assistant")).cast(MESSAGES_TYPE)


def chat_sample(df: DataFrame, *keep: str, instruction: str = "OCR:") -> DataFrame:
    """``images, messages`` from ``text, image``."""
    text = collapse(F.col("text"))
    return df.select(
        F.array(F.col("image").cast(IMAGE_TYPE)).alias("images"),
        chat_messages(text, F.col("image"), instruction).alias("messages"),
        *keep,
    )


def chat_error(key: Column, error: Column) -> Column:
    """Messages that tell of a sample that could not be made."""
    part = F.struct(F.lit(None).cast(IMAGE_TYPE).alias("image"), error.alias("text"), key.alias("type"))
    return F.array(F.struct(F.array(part).alias("content"), F.lit("error").alias("role"))).cast(MESSAGES_TYPE)


def told_by_chat(messages: Column) -> tuple[Column, Column]:
    """Key and error of ``chat_error``."""
    part = messages[0]["content"][0]
    return part["type"], part["text"]


def instruction_error(key: Column, error: Column) -> Column:
    """A ``text_info`` that tells of a sample that could not be made."""
    return F.array(F.struct(error.alias("text"), key.alias("tag")))


def told_by_instruction(text_info: Column) -> tuple[Column, Column]:
    """Key and error of ``instruction_error``."""
    return text_info[0]["tag"], text_info[0]["text"]


def instruction_sample(
    df: DataFrame, *keep: str, instruction: str = "OCR:", assets_prefix: str = "./assets/"
) -> DataFrame:
    """``image_info, text_info`` from ``basename, text``; the instruction is masked."""
    url = F.concat(F.lit(assets_prefix), F.col("basename"), F.lit(".png"))
    info = F.struct(F.lit(0).alias("matched_text_index"), url.alias("image_url"))

    def tagged(text: Column, tag: str) -> Column:
        return F.struct(text.alias("text"), F.lit(tag).alias("tag"))

    return df.select(
        F.array(info).alias("image_info"),
        F.array(
            tagged(F.lit(instruction), "mask"), tagged(collapse(F.col("text")), "no_mask")
        ).alias("text_info"),
        *keep,
    )
