"""Permission lists of files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted roles and kinds of a share.
SHARE_ROLES = ("reader", "commenter", "writer")
SHARE_TYPES = ("user", "group", "domain", "anyone")


def is_public(permissions: Column) -> Column:
    """True when anyone may read, comment or write."""
    found = F.exists(
        permissions, lambda p: (p["type"] == "anyone") & p["role"].isin(*SHARE_ROLES)
    )
    return F.coalesce(found, F.lit(False))


def permission_sentence(p: Column) -> Column:
    """One line for a permission: who, role, id, then expiry and where it is inherited from."""
    kind = F.coalesce(p["type"], F.lit("unknown"))
    role = F.coalesce(p["role"], F.lit("unknown"))
    email = F.coalesce(p["emailAddress"], F.lit("unknown"))
    domain = F.coalesce(p["domain"], F.lit("unknown"))
    who = (
        F.when(kind == "anyone", F.lit("Anyone with the link"))
        .when(kind == "user", F.concat(F.lit("User: "), email))
        .when(kind == "group", F.concat(F.lit("Group: "), email))
        .when(kind == "domain", F.concat(F.lit("Domain: "), domain))
        .otherwise(kind)
    )
    tail = F.concat(F.lit(" ("), role, F.lit(") [id: "), F.coalesce(p["id"], F.lit("")), F.lit("]"))
    inherited = F.filter(
        p["permissionDetails"],
        lambda d: d["inherited"] & (F.coalesce(d["inheritedFrom"], F.lit("")) != ""),
    )
    source = F.try_element_at(inherited, F.lit(1))["inheritedFrom"]
    extras = F.concat_ws(
        ", ",
        F.when(p["expirationTime"] != "", F.concat(F.lit("expires: "), p["expirationTime"])),
        F.concat(F.lit("inherited from: "), source),
    )
    return F.concat(who, tail, F.when(extras != "", F.concat(F.lit(" | "), extras)).otherwise(""))
