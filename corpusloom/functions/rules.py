"""JSON fields and ordered substring rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import col_of, suffix_of

# --- fixed values -------------------------------------------------------------------------------------
# Ordered rules for the family of a model, first hit wins.
FAMILY_RULES: tuple[tuple[tuple[str, ...], str], ...] = (
    (("bitnet",), "bitnet"),
    (("llama", "mistral", "mixtral"), "llama"),
    (("moe", "qwen", "deepseek", "gpt-neox"), "moe"),
    (("phi",), "phi"),
    (("gpt",), "gpt"),
)
# A later pass that may override the family.
FAMILY_OVERRIDES: tuple[tuple[tuple[str, ...], str], ...] = (
    (("moe", "mixture", "qwen"), "moe"),
    (("bitnet",), "bitnet"),
)
DEFAULT_FAMILY = "hf"
# File suffixes and file names that decide the family before anything else.
PACKED_SUFFIXES = (".gguf", ".ggml")
PACKED_FAMILY = "gguf"
LISTING_RULES: tuple[tuple[tuple[str, ...], str], ...] = ((("ggml",), "gguf"), (("pytorch_model",), "hf"))
# Size tags in a model name and the parameter counts they stand for.
SIZE_TAGS: tuple[tuple[str, float], ...] = (("-1.5b", 1.5e9), ("-7b", 7e9), ("-14b", 14e9), ("-72b", 72e9))
LARGE_PARAMS = 10e9
# Size tags count in names of this family.
TAGGED_FAMILY = "qwen"
# Paths into a model manifest and into one raw chunk.
MANIFEST_PATHS = {
    "architecture": "$.architectures[0]",
    "model_type": "$.model_type",
    "num_params": "$.num_params",
}
VISION_PATHS = ("$.vision_config", "$.vision_encoder")
CHUNK_CONTENT_PATH = "$.choices[0].delta.content"
# Error text -> (category, suggestion), first hit wins.
ERROR_RULES: tuple[tuple[str, str, str], ...] = (
    ("CUDA out of memory", "gpu_memory", "load in 4 bit, or run on the CPU"),
    ("configuration_bitnet.py", "bitnet_config", "install the library version that knows this architecture"),
    ("No such file or directory", "missing_path", "check the path and that the download is complete"),
)
DEFAULT_ERROR = ("load_failed", "check that the files are complete, or download them again")
# ------------------------------------------------------------------------------------------------------


def json_fields(value: Column | str, paths: Mapping[str, str], defaults: Mapping[str, str] | None = None) -> Column:
    """A struct with one text field per path; an absent key or broken JSON gives the default, else null."""
    defaults = defaults or {}
    fields = []
    for name, path in paths.items():
        field = F.get_json_object(col_of(value), path)
        if name in defaults:
            field = F.coalesce(field, F.lit(defaults[name]))
        fields.append(field.alias(name))
    return F.struct(*fields)


def json_has_any(value: Column | str, paths: Sequence[str] = VISION_PATHS) -> Column:
    found = F.lit(False)
    for path in paths:
        found = found | F.get_json_object(col_of(value), path).isNotNull()
    return found


def chunk_content(value: Column | str) -> Column:
    """Content of a raw JSON chunk; any missing level gives null."""
    return F.get_json_object(col_of(value), CHUNK_CONTENT_PATH)


def _contains_any(value: Column, needles: Sequence[str]) -> Column:
    hit = value.contains(needles[0])
    for needle in needles[1:]:
        hit = hit | value.contains(needle)
    return hit


def classify_by_rules(
    value: Column | str,
    rules: Sequence[tuple[Sequence[str], str]] = FAMILY_RULES,
    default: str | Column | None = DEFAULT_FAMILY,
) -> Column:
    """Label of the first rule with a needle inside the lower-cased text."""
    low = F.lower(F.coalesce(col_of(value), F.lit("")))
    label = None
    for needles, name in rules:
        hit = _contains_any(low, needles)
        label = F.when(hit, name) if label is None else label.when(hit, name)
    fallback = default if isinstance(default, Column) else F.lit(default)
    return fallback if label is None else label.otherwise(fallback)


def is_packed(path: Column | str, suffixes: Sequence[str] = PACKED_SUFFIXES) -> Column:
    """Whether a file name ends with one of the suffixes, in any case of letters; null names don't."""
    return F.coalesce(suffix_of(path).isin(*suffixes), F.lit(False))


def model_family(architecture: Column | str, model_type: Column | str, path: Column | str | None = None) -> Column:
    """Family from the rules, then the overriding pass. The first rule also looks at ``model_type``.

    The suffix of a packed file decides before anything else.
    """
    first_needles, first_label = FAMILY_RULES[0]
    by_type = _contains_any(F.lower(F.coalesce(col_of(model_type), F.lit(""))), first_needles)
    base = F.when(by_type, F.lit(first_label)).otherwise(classify_by_rules(architecture))
    family = classify_by_rules(architecture, FAMILY_OVERRIDES, base)
    return family if path is None else F.when(is_packed(path), PACKED_FAMILY).otherwise(family)


def size_from_name(
    name: Column | str,
    num_params: Column | str | None = None,
    tags: Sequence[tuple[str, float]] = SIZE_TAGS,
    only_with: str = TAGGED_FAMILY,
) -> Column:
    """The stated parameter count, else the one its size tag stands for, else 0.

    Tags count in names that contain ``only_with``; an empty one reads the tags of all names.
    """
    low = F.lower(F.coalesce(col_of(name), F.lit("")))
    by_tag = None
    for tag, count in tags:
        hit = low.contains(tag) & low.contains(only_with)
        by_tag = F.when(hit, F.lit(count)) if by_tag is None else by_tag.when(hit, F.lit(count))
    by_tag = by_tag.otherwise(F.lit(0.0))
    if num_params is None:
        return by_tag
    stated = col_of(num_params).try_cast("double")
    return F.when(stated != 0, stated).otherwise(by_tag)


def is_large(num_params: Column | str, limit: float = LARGE_PARAMS) -> Column:
    return col_of(num_params) > limit


def triage_messages(
    message: Column | str,
    rules: Sequence[tuple[str, str, str]] = ERROR_RULES,
    default: tuple[str, str] = DEFAULT_ERROR,
) -> Column:
    """``struct(category, detail, suggestion)`` by the first needle found; the detail keeps the message."""
    text = F.coalesce(col_of(message), F.lit(""))
    category, suggestion = F.lit(default[0]), F.lit(default[1])
    for needle, label, advice in reversed(rules):
        hit = text.contains(needle)
        category = F.when(hit, label).otherwise(category)
        suggestion = F.when(hit, advice).otherwise(suggestion)
    return F.struct(category.alias("category"), text.alias("detail"), suggestion.alias("suggestion"))
