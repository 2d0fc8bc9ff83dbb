"""Which narrower grants a broad grant covers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The grants and what they include, without the prefix that all of them share.
PREFIX = "https://www.googleapis.com/auth/"

# Broad grant to the grants it covers, all below PREFIX.
COVERS = {
    "gmail.modify": ["gmail.readonly", "gmail.send", "gmail.compose", "gmail.labels"],
    "drive": ["drive.readonly", "drive.file"],
    "calendar": ["calendar.readonly", "calendar.events"],
    "documents": ["documents.readonly"],
    "spreadsheets": ["spreadsheets.readonly"],
    "presentations": ["presentations.readonly"],
    "tasks": ["tasks.readonly"],
    "contacts": ["contacts.readonly"],
    "chat.messages": ["chat.messages.readonly"],
    "chat.spaces": ["chat.spaces.readonly"],
    "forms.body": ["forms.body.readonly"],
    "script.projects": ["script.projects.readonly"],
    "script.deployments": ["script.deployments.readonly"],
}

HIERARCHY = {PREFIX + broad: [PREFIX + n for n in narrow] for broad, narrow in COVERS.items()}


def expanded(scope: Column, hierarchy: dict[str, list[str]]) -> Column:
    """The grant itself and those it covers, one level deep, as a list."""
    entries = []
    for broad, narrow in hierarchy.items():
        entries += [F.lit(broad), F.array(*[F.lit(n) for n in narrow])]
    if not entries:
        return F.array(scope)
    covered = F.try_element_at(F.create_map(*entries), scope)
    return F.concat(F.array(scope), F.coalesce(covered, F.array().cast("array<string>")))
