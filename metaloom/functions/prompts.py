"""Prompt texts built from columns.

The template is one literal; its `{SLOT}` marks are filled by `format_slots`. Slots are filled in one
pass over the template's own parts, so a value that looks like a slot is never filled again.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# The sizes reported as large.
LARGE_PROMPT_SIZES = [10000, 15000, 20000]

# The texts around the page content.
CONTENT_HEAD = "**Webpage Content** (extracted text):\n"
CONTENT_NOTE = (
    "\n\n**Note**: The above is the extracted text content from the webpage. "
    "Please analyze it to identify datasets and extract metadata."
)
POINTER_HEAD = "**Important**: Please analyze the content at this URL: "
POINTER_NOTE = (
    "\n\nIf you have URL Context Tool access, fetch and analyze the webpage content directly. "
    "Otherwise, use your knowledge of the domain and URL structure to infer what datasets "
    "might be available."
)

_SLOT = re.compile(r"\{\{|\}\}|\{([A-Z_]+)\}")


def format_slots(template: str, values: dict[str, Column]) -> Column:
    """Fill `{SLOT}` marks; doubled braces stand for one brace; an unknown slot is an error."""
    parts: list[Column] = []
    last = 0
    for match in _SLOT.finditer(template):
        if match.start() > last:
            parts.append(F.lit(template[last : match.start()]))
        slot = match.group(1)
        parts.append(F.coalesce(values[slot], F.lit("")) if slot else F.lit(match.group(0)[0]))
        last = match.end()
    if last < len(template):
        parts.append(F.lit(template[last:]))
    return F.concat(*parts) if parts else F.lit("")


def _cut(text: Column, length: int | None) -> Column:
    return text if length is None else F.left(text, F.lit(length))


def content_section(url: Column, content: Column, length: int | None = None) -> Column:
    """Page text for the reader, whole unless a `length` is given; without text, a pointer to the URL."""
    with_text = F.concat(F.lit(CONTENT_HEAD), _cut(content, length), F.lit(CONTENT_NOTE))
    without = F.concat(F.lit(POINTER_HEAD), url, F.lit(POINTER_NOTE))
    return F.when(F.coalesce(content, F.lit("")) != "", with_text).otherwise(without)


def detection_prompt(
    template: str,
    url: Column,
    content: Column,
    name: Column,
    group: Column,
    description: Column,
    content_length: int | None = None,
) -> Column:
    return format_slots(
        template,
        {
            "URL": url,
            "CONTENT_SECTION": content_section(url, content, content_length),
            "DATASET_NAME": name,
            "GROUP": group,
            "DESCRIPTION": description,
        },
    )


def _double_braces(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("{"), F.lit("{{")), F.lit("}"), F.lit("}}"))


def generation_prompt(
    template: str,
    metadata: dict[str, Column],
    extracted_json: Column,
    example: Column,
    example_length: int | None = None,
) -> Column:
    """Fill the eleven slots of the generation template.

    `metadata` maps name, url, description, group, creator, provider, publisher, keywords and
    spatial_coverage to columns. Braces of the two JSON slots are doubled.
    """
    names = [
        "name",
        "url",
        "description",
        "group",
        "creator",
        "provider",
        "publisher",
        "keywords",
        "spatial_coverage",
    ]
    slots = {n.upper(): metadata.get(n, F.lit("")) for n in names}
    slots["DATASET_NAME"] = slots.pop("NAME")
    slots["EXTRACTED_METADATA"] = _double_braces(extracted_json)
    slots["EXAMPLE_JSONLD"] = _double_braces(
        _cut(F.coalesce(example, F.lit("")), example_length)
    )
    return format_slots(template, slots)


def is_large_prompt(prompt: Column, limit: int = LARGE_PROMPT_SIZES[0]) -> Column:
    return F.length(prompt) > limit
