"""Rules for extension manifests: a declarative specification, compiled to one column over VARIANT."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import trim
from .json_rules import all_of, each, is_array, is_null, is_object, is_text, items_of, keys_of, none, say, schema_errors, text_of, value_of

#: The version, and patterns of ids and versions.
VERSION = "1.0.0"
ID = r"^[a-z][a-z0-9]*(-[a-z0-9]+)*\z"
SEMVER = r"^\d+\.\d+\.\d+(-[0-9A-Za-z.-]+)?\z"

#: Fields in the order in which errors are told, those after '/' without a rule. 'id:kebab' wants that form.
ITEMS = {
    "toolsMenu": "id:kebab label / action separatorBefore",
    "autoTagging": "id label kind:kind / description defaultEnabled tags",
    "authorityPacks": "id label install / defaultTag",
    "settingsSections": "id label / description",
    "disambiguation": "id label entityKind / description usesContextKeys",
}
TOP = ["manifestVersion", "id", "name", "version", "description", "author", "homepage", "license", "host", "languages", "regions", "languagePrompt", "entry", "contributions", "dependencies", "bundled"]
REGIONS = ["east-asia", "china", "japan", "korea"]
KINDS = ["dates", "authority-tag-bomb", "contextual-disambiguation", "pattern-tag", "custom"]
INSTALL = {"bundled": "path", "authoritypacks-release": "releaseId", "url": "url"}

Check = Callable[[Column, Column], Column]


def _like_object(v: Column) -> Column:
    """An object; an array is one with numbers for keys; nothing else is."""
    return is_object(v) | is_array(v)


def _unknown(v: Column, allowed: list[str], path: Column) -> Column:
    names = F.coalesce(keys_of(v), F.transform(items_of(v), lambda x, i: i.cast("string")))
    return F.coalesce(F.transform(F.filter(names, lambda k: ~k.isin(allowed)), lambda k: F.concat(path, F.lit("."), k, F.lit(" is not allowed"))), none())


def _text(v: Column, path: Column) -> Column:
    return say(~(is_text(v) & (trim(F.coalesce(text_of(v), F.lit(""))) != "")), path, " must be a non-empty string")


def _fits(v: Column, pattern: str, path: Column, what: str) -> Column:
    return say(is_text(v) & ~F.coalesce(text_of(v).rlike(pattern), F.lit(False)), path, f" must be {what}")


def _texts(v: Column, path: Column) -> Column:
    return F.when(is_array(v), each(v, _text, path)).otherwise(say(F.lit(True), path, " must be an array"))


def _given(v: Column, path: Column, check: Check) -> Column:
    """check, unless v is absent or null."""
    return F.when(is_null(v), none()).otherwise(check(v, path))


def _object(v: Column, path: Column, allowed: list[str], *checks: Column, what: str = "must be an object") -> Column:
    return F.when(~_like_object(v), say(F.lit(True), path, f" {what}")).otherwise(all_of(_unknown(v, allowed, path), *checks))


def _at(path: Column, name: str) -> Column:
    return F.concat(path, F.lit(f".{name}"))


def _install(v: Column, path: Column) -> Column:
    source = value_of(v, "source")
    lacks = [say(is_text(source) & (text_of(source) == kind) & ~is_text(value_of(v, field)), path, f".{field} is required when source={kind}") for kind, field in INSTALL.items()]
    return _object(v, path, ["source", "path", "releaseId", "url", "manifestPath"], _text(source, _at(path, "source")), *lacks, what="is required")


def _item(spec: str) -> Check:
    """The check of an item with the fields of an entry of ITEMS."""
    ruled, free = (x.split() for x in spec.split(" / "))
    names = [x.split(":")[0] for x in ruled]

    def check(v: Column, path: Column) -> Column:
        found, forms = [], []
        for name, form in (x.partition(":")[::2] for x in ruled):
            own, at = value_of(v, name), _at(path, name)
            found.append(_install(own, at) if name == "install" else _text(own, at))
            if form == "kebab":
                forms.append(_fits(own, ID, at, "kebab-case"))
            elif form == "kind":
                forms.append(say(is_text(own) & ~text_of(own).isin(KINDS), at, " is invalid"))
        return _object(v, path, names + free, *found, *forms)

    return check


def _entry(v: Column, group: str) -> Column:
    path, kind, module, python = F.lit("entry"), value_of(v, "kind"), value_of(v, "module"), value_of(v, "python")
    is_kind = lambda *kinds: is_text(kind) & text_of(kind).isin(*kinds)
    inner = F.when(~_like_object(python), say(F.lit(True), f"entry.python is required for python/hybrid {group}")).otherwise(all_of(_unknown(python, ["module", "runtime", "runtimePath"], F.lit("entry.python")), _text(value_of(python, "module"), F.lit("entry.python.module"))))
    return _object(
        v, path, ["kind", "module", "python"],
        say(~is_kind("javascript", "python", "hybrid"), "entry.kind must be javascript, python, or hybrid"),
        say(is_kind("javascript", "hybrid") & ~is_text(module), f"entry.module is required for javascript/hybrid {group}"),
        F.when(is_kind("python", "hybrid"), inner).otherwise(none()),
    )


def _contributions(v: Column, path: Column) -> Column:
    def listed(name: str) -> Column:
        own, at = value_of(v, name), _at(path, name)
        return _given(own, at, lambda x, p: F.when(is_array(x), each(x, _item(ITEMS[name]), p)).otherwise(say(F.lit(True), p, " must be an array")))

    return _object(v, path, list(ITEMS), *map(listed, ITEMS))


def _shown(v: Column) -> Column:
    return F.when(is_text(v), text_of(v)).otherwise(F.to_json(v))


def manifest_errors(v: Column, host: str = "host", group: str = "extensions") -> Column:
    """array<string>: the errors of a manifest, a VARIANT, in the order of its fields; empty if it is valid.

    Fields that are not allowed are told in alphabetical order. host names the field with the host's versions, group the
    field of dependencies that lists others of the kind, and the kind in messages.
    """
    one = lambda name: (value_of(v, name), F.lit(name))
    regions = F.transform(F.filter(items_of(value_of(v, "regions")), lambda x: ~F.coalesce(is_text(x) & text_of(x).isin(REGIONS), F.lit(False))), lambda x: F.concat(F.lit("regions contains invalid value: "), _shown(x)))
    versions = lambda x, p: _object(x, p, ["minVersion", "maxVersion"], _text(value_of(x, "minVersion"), _at(p, "minVersion")), _given(value_of(x, "maxVersion"), _at(p, "maxVersion"), _text))
    prompt = lambda x, p: _object(x, p, ["message", "documentLanguages"], _text(value_of(x, "message"), _at(p, "message")), _given(value_of(x, "documentLanguages"), _at(p, "documentLanguages"), _texts))

    def others(x: Column, path: Column) -> Column:
        own, at = value_of(x, group), _at(path, group)
        invalid = F.transform(F.filter(items_of(own), lambda i: ~F.coalesce(is_text(i) & text_of(i).rlike(ID), F.lit(False))), lambda i: F.concat(at, F.lit(" contains invalid id: "), _shown(i)))
        return _object(x, path, [group], _given(own, at, lambda y, p: all_of(_texts(y, p), F.coalesce(invalid, none()))))

    found = all_of(
        _unknown(v, [host if k == "host" else k for k in TOP], F.lit("manifest")),
        say(~(is_text(value_of(v, "manifestVersion")) & (text_of(value_of(v, "manifestVersion")) == VERSION)), f"manifestVersion must be {VERSION}"),
        _text(*one("id")), _fits(*one("id")[:1], ID, F.lit("id"), "kebab-case"), _text(*one("name")), _text(*one("version")), _fits(*one("version")[:1], SEMVER, F.lit("version"), "semver"), _text(*one("description")), _text(*one("license")),
        _given(*one("author"), _text), _given(*one("homepage"), _text), versions(*one(host)), _given(*one("languages"), _texts),
        _given(*one("regions"), lambda x, p: F.when(is_array(x), regions).otherwise(say(F.lit(True), p, " must be an array"))),
        _given(*one("languagePrompt"), prompt), _entry(value_of(v, "entry"), group), _given(*one("contributions"), _contributions), _given(*one("dependencies"), others), _given(*one("bundled"), _texts),
    )
    return F.when(_like_object(v), found).otherwise(F.array(F.lit("manifest must be an object")))


def validate(manifests: DataFrame, schema: dict | None = None, raw_col: str = "raw", host: str = "host", group: str = "extensions") -> DataFrame:
    """manifests with errors array<string> and ok. schema: a JSON Schema whose errors follow those of the rules.

    Null is taken as JSON's null. What is not JSON, or tells a field twice, has one error. Rows are dealt evenly over
    spark.sql.shuffle.partitions tasks first: rules cost more than a row's way, and a small file may hold very many manifests.
    """
    raw = F.coalesce(F.col(raw_col), F.lit("null"))
    v = F.col("__v")
    errors = F.when(v.isNull(), F.array(F.lit("manifest is not JSON"))).otherwise(manifest_errors(v, host, group))
    if schema is not None:
        errors = F.when(v.isNull(), errors).otherwise(F.concat(errors, schema_errors(raw, schema, "manifest")))
    # parsed once: a generator ends what may be merged into the expressions above it
    dealt = manifests.repartition(int(manifests.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = dealt.withColumn("__v", F.explode(F.array(F.try_parse_json(raw))))
    return rows.withColumn("errors", errors).drop("__v").withColumn("ok", F.size("errors") == 0)


def read_manifests(spark: SparkSession, pattern: str, skip: str = "sdk") -> DataFrame:
    """(path, raw) of every manifest file that a glob finds, but for those in the skipped directory; an error if none."""
    found = spark.read.text(pattern, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw")).where(~F.contains("path", F.lit(f"/{skip}/")))
    if found.isEmpty():
        raise FileNotFoundError(f"no manifests at {pattern}")
    return found
