"""Answer text out of logged response bodies of the usual chat endpoints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerweave.functions.jsontext import strict_record
from ledgerweave.functions.text import strip

STYLES = ("choices", "message", "response", "blocks")


def completion_text(body: Column, style: str) -> Column:
    """The trimmed answer; null for a body without one.

    ``choices`` reads ``choices[0].message.content`` and ``blocks`` reads
    ``content[0].text``.  ``message`` and ``response`` read ``message.content``
    and ``response``, where a missing key means the empty string.
    """
    top = strict_record(body, "map<string,string>")
    if style == "choices":
        found = F.get_json_object(top["choices"], "$[0].message.content")
    elif style == "blocks":
        found = F.get_json_object(top["content"], "$[0].text")
    elif style == "response":
        found = F.when(F.map_contains_key(top, "response"), top["response"]).otherwise(
            F.when(top.isNotNull(), ""))
    elif style == "message":
        inner = F.when(F.map_contains_key(top, "message"),
                       strict_record(top["message"], "map<string,string>")).otherwise(
            F.when(top.isNotNull(), F.create_map().cast("map<string,string>")))
        found = F.when(F.map_contains_key(inner, "content"), inner["content"]).otherwise(
            F.when(inner.isNotNull(), ""))
    else:
        raise ValueError(f"unknown response style: {style!r}")
    return strip(found)
