"""Column functions over instructions, prompts, names and JSON in text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_INSTRUCTION = "Complete the demonstrated manipulation."
MEDIA = ("<image>", "<video>")  # fixed values: placeholders in prompts
UNITS = ("B", "KiB", "MiB", "GiB", "TiB")


def clean_instruction(text: Column, default: str = DEFAULT_INSTRUCTION) -> Column:
    """White space collapsed; a text without anything else becomes the default."""
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit("")), F.lit(default))


def split_media(prompt: Column) -> Column:
    """The prompt's pieces, placeholders being pieces of their own; empty pieces are left out."""
    either = "|".join(MEDIA)
    return F.filter(F.split(prompt, f"(?={either})|(?<=<image>)|(?<=<video>)"), lambda p: p != "")


def placeholders(prompt: Column, kind: str = "<image>") -> Column:
    return F.regexp_count(prompt, F.lit(kind))


def chat_role(speaker: Column) -> Column:
    return F.when(speaker == "human", "user").otherwise("assistant")


def word_count(text: Column) -> Column:
    """Pieces between white space."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != ""))


def history_prompt(question: Column, n_images: Column) -> Column:
    """The question after n - 1 history placeholders and one of the current view."""
    return F.concat(F.repeat(F.lit("<image>\n"), n_images - 1), F.lit("<image>\n"), question)


def with_state(instruction: Column, tokens: Column) -> Column:
    return F.concat(instruction, F.lit(" [STATE] "), tokens, F.lit(" [ACTION]"))


def with_action_tokens(instruction: Column, token: str, n: int) -> Column:
    return F.concat(instruction, F.repeat(F.lit(token), n))


def json_in_text(text: Column) -> Column:
    """From the first brace to the last one, over lines; null if there is none."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def action_mode(name: Column) -> Column:
    """abs, absolute, raw and none are one mode; delta and rel stand; anything else is null."""
    plain = F.lower(F.trim(name))
    return F.when(plain.isin("abs", "absolute", "raw", "none", ""), "abs").when(plain.isin("delta", "rel"), plain)


def prefixed(key: Column, kind: str) -> Column:
    return F.when(key.startswith(f"{kind}."), key).otherwise(F.concat(F.lit(f"{kind}."), key))


def human_bytes(size: Column, units: Sequence[str] = UNITS) -> Column:
    """A whole number of bytes in the largest of the units that it reaches, rounded half to even from its exact value."""
    out = None
    for power, unit in enumerate(units):
        value = size / float(1024**power)
        whole = F.floor(value).cast("double")  # the rest alone has digits enough to tell a tie from a number beside it
        text = F.format_string(f"%.2f {unit}", whole + F.bround(value - whole, 2))
        below = F.abs(size) < float(1024 ** (power + 1)) if power < len(units) - 1 else F.lit(True)
        out = F.when(below, text) if out is None else out.when(below, text)
    return out


def config_key(text: Column, length: int = 12) -> Column:
    return F.substring(F.md5(text.cast("binary")), 1, length)


def seed_128(text: Column) -> Column:
    """The low 128 bits of a sha-256 as hexadecimal digits."""
    return F.right(F.sha2(text.cast("binary"), 256), F.lit(32))
