"""Topic, joint, label and option names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Message types of the three known kinds of topic.
JOINT_STATE = "sensor_msgs/JointState"
IMAGES = ("sensor_msgs/CompressedImage", "sensor_msgs/Image")
MULTI_ARRAY = "std_msgs/Float64MultiArray"
#: Accepted spellings of sizes and facing sides.
SIZE_ALIASES = {
    "big": "big", "large": "big", "l": "big", "b": "big", "grande": "big",
    "medium": "medium", "med": "medium", "m": "medium", "medio": "medium", "médio": "medium",
    "small": "small", "s": "small", "pequeno": "small",
}
FACE_ALIASES = {
    "face_up": "face_up", "faceup": "face_up", "face-up": "face_up", "up": "face_up", "upside": "face_up", "u": "face_up", "cima": "face_up", "true": "face_up",
    "face_down": "face_down", "facedown": "face_down", "face-down": "face_down", "down": "face_down", "downside": "face_down", "d": "face_down", "baixo": "face_down", "false": "face_down",
}
#: Prefixes of joint names and the role and arm they stand for.
ROLE_OF_PREFIX = {"leader": "action", "follower": "observation"}
ARM_OF_TOKEN = {"r": "right", "l": "left"}
#: Image suffixes of topics, in the order they are tried.
IMAGE_SUFFIXES = ("image_raw/compressed", "image/compressed", "compressed", "image_raw", "image")


def lookup(value: Column, table: dict[str, str]) -> Column:
    """The entry of a literal table; NULL if there is none."""
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), value)


def normalize_schema_name(name: Column) -> Column:
    """A message type without URI prefix and ``/msg/`` infix."""
    return F.replace(F.replace(name, F.lit("ros2msg://"), F.lit("")), F.lit("/msg/"), F.lit("/"))


def fallback_label(topic: Column) -> Column:
    """A topic as a label: no leading slashes, others as underscores."""
    return F.replace(F.ltrim(topic, F.lit("/")), F.lit("/"), F.lit("_"))


def topic_role(schema: Column) -> Column:
    """stream, action or unclassified by message type."""
    kind = normalize_schema_name(schema)
    return F.when(kind.isin(JOINT_STATE, *IMAGES), "stream").when(kind == MULTI_ARRAY, "action").otherwise("unclassified")


def topic_label(topic: Column, schema: Column) -> Column:
    """The label of a topic: joint_states, the camera's name, the arm of an action, else its name."""
    kind = normalize_schema_name(schema)
    camera = F.nullif(F.regexp_extract(topic, "^/cam_([^/]+)/image_raw", 1), F.lit(""))
    side = lookup(F.regexp_extract(topic, "^/follower_([lr])_.*controller/commands$", 1), ARM_OF_TOKEN)
    plain = fallback_label(topic)
    return F.when(kind == JOINT_STATE, "joint_states").when(kind.isin(*IMAGES), F.coalesce(camera, plain)).when(kind == MULTI_ARRAY, F.concat(F.lit("action["), F.coalesce(side, plain), F.lit("]"))).otherwise(plain)


def parse_joint_name(name: Column, roles: dict[str, str] | None = None, arms: dict[str, str] | None = None, sep: str = "_") -> Column:
    """STRUCT<role, robot, joint> of a joint name; NULL without a known role, or with an unknown arm before further parts."""
    roles, arms = ROLE_OF_PREFIX if roles is None else roles, ARM_OF_TOKEN if arms is None else arms
    role = rest = F.lit(None).cast("string")
    for prefix, meaning in reversed(roles.items()):
        hit = F.startswith(name, F.lit(prefix + sep))
        role = F.when(hit, F.lit(meaning)).otherwise(role)
        rest = F.when(hit, F.substring(name, len(prefix + sep) + 1, 1 << 20)).otherwise(rest)
    head, tail = F.substring_index(rest, sep, 1), F.nullif(F.instr(rest, sep), F.lit(0))
    joint_tail = F.when(tail.isNotNull(), F.substr(rest, tail + F.lit(len(sep))))
    arm = lookup(head, arms) if arms else F.lit(None).cast("string")
    known = arm.isNotNull()
    dropped = role.isNull() | (~known & F.lit(bool(arms)) & tail.isNotNull())
    return F.when(~dropped, F.struct(role.alias("role"), F.coalesce(arm, F.lit("")).alias("robot"), F.when(known, F.coalesce(joint_tail, head)).otherwise(rest).alias("joint")))


def camera_name(topic: Column) -> Column:
    """A clean camera name of an image topic: first matching suffix off, slashes as underscores, ``camera`` if nothing is left."""
    text = F.ltrim(topic, F.lit("/"))
    out = text
    for suffix in reversed(IMAGE_SUFFIXES):
        out = F.when(F.endswith(text, F.lit(suffix)), F.left(text, F.length(text) - len(suffix))).otherwise(out)
    return F.coalesce(F.nullif(F.rtrim(F.replace(out, F.lit("/"), F.lit("_")), F.lit("_")), F.lit("")), F.lit("camera"))


def source_camera_name(topic: Column) -> Column:
    """First part of a topic's path."""
    return F.split_part(F.ltrim(topic, F.lit("/")), F.lit("/"), F.lit(1))


def label_alias(raw: Column, aliases: dict[str, str]) -> Column:
    """A label in its one spelling; NULL if unknown (an error is the caller's choice, see :func:`require_alias`)."""
    return lookup(F.replace(F.lower(F.trim(raw)), F.lit(" "), F.lit("_")), aliases)


def require_alias(raw: Column, aliases: dict[str, str], what: str) -> Column:
    """As :func:`label_alias`, but a non-null unknown value stops the query."""
    known = label_alias(raw, aliases)
    return F.when(raw.isNull() | known.isNotNull(), known).otherwise(F.raise_error(F.concat(F.lit(f"unrecognised {what}: "), raw)).cast("string"))


def stratum(size: Column, face: Column) -> Column:
    """``size|face``; NULL if either is."""
    return F.when(size.isNotNull() & face.isNotNull(), F.concat_ws("|", size, face))


def action_type(kind: Column, legacy_delta: Column) -> Column:
    """The action type, from the legacy flag if it isn't given."""
    return F.coalesce(kind, F.when(legacy_delta, "delta_obs_t").otherwise("absolute"))


def shown_names(names: Column, limit: int = 20) -> Column:
    """The first names as text, and how many more there are."""
    head = F.array_join(F.slice(names, 1, limit), ", ")
    return F.when(F.size(names) > limit, F.concat(head, F.lit(" ... and "), (F.size(names) - limit).cast("string"), F.lit(" more"))).otherwise(head)
