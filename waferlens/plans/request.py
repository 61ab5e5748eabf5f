"""Requests: validated once, then plain data.

A request names an algorithm, filters, merge rules and group keys.  Comma
lists inside step lists are split; merging all product groups also merges all
products; unknown algorithms and missing upload ids are errors.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

DEFAULT_KEYS = ("PRODG1", "PRODUCT_ID", "OPE_NO", "EQP_NAME", "CHAMBER_NAME")
_FAMILIES = ("inline_by", "wat_by", "correlation_by")
_NAMED = ("uva", "fdc_advanced", "defect")
#: Request field -> column of its merge rules.
MERGES = {"mergeProdg1": "PRODG1", "mergeProductId": "PRODUCT_ID", "mergeEqp": "EQP_NAME", "mergeChamber": "CHAMBER_NAME", "mergeOperno": "OPE_NO", "mergeParametricName": "PARAMETRIC_NAME", "mergedParametricName": "PARAMETRIC_NAME", "mergeLayerId": "LAYER_ID"}
#: Request field -> column that its values restrict.
FILTERS = {"prodg1": "PRODG1", "productId": "PRODUCT_ID", "eqp": "EQP_NAME", "chamber": "CHAMBER_NAME", "tool": "EQP_NAME", "operNo": "OPE_NO", "lot": "LOT_ID", "recipeName": "RECIPE_NAME", "layerId": "LAYER_ID", "parametricName": "PARAMETRIC_NAME"}


class RequestError(ValueError):
    """What a caller can correct."""


def algorithm_of(name: str | None) -> tuple[str, str]:
    """(source, granularity).  After an exact name, by_wafer and by_site are told apart; any other by_* means by zone."""
    if name in _NAMED:
        return str(name), "wafer"
    for family in _FAMILIES:
        if name and name.startswith(family):
            part = name.removeprefix(family)
            return family.removesuffix("_by"), {"_wafer": "wafer", "_site": "site"}.get(part, "zone")
    raise RequestError(f"unknown algorithm: {name}")


def _split(values: Any) -> tuple[str, ...]:
    if values is None:
        return ()
    return tuple(x for v in ([values] if isinstance(values, str) else values) for x in str(v).split(",") if x)


@dataclass(frozen=True)
class Request:
    request_id: str
    source: str
    granularity: str
    upload_id: str | None
    keys: tuple[str, ...]
    merges: Mapping[str, tuple[tuple[str, ...], ...]]
    filters: Mapping[str, tuple[str, ...]]
    #: (start, end) pairs, either of which may be open; rows of any of them count.
    ranges: tuple[tuple[str | None, str | None], ...] = ((None, None),)
    good_sites: tuple[str, ...] = ()
    bad_sites: tuple[str, ...] = ()
    zones: Mapping[str, Mapping[str, tuple[str, ...]]] = field(default_factory=dict)
    parts: Mapping[str, Request] = field(default_factory=dict)
    model: str = "anova"
    item_type: int | None = None
    filter_upload_id: str | None = None


#: Scores that a request may name.
MODELS = ("anova", "chi2", "mutual_info", "rf", "decisionTree", "svc", "logistic", "sgd", "sgd:hinge", "sgd:log_loss", "sgd:perceptron", "sgd:huber")


def group_keys(params: Mapping[str, Any], default: tuple[str, ...] = DEFAULT_KEYS) -> tuple[tuple[str, ...], frozenset[str]]:
    """Group keys, and the merge columns that a merge-all switch makes void."""
    own = params.get("groupByList")
    if own is not None:  # an empty list: no grouping at all
        return tuple(own), frozenset()
    dropped = {"PRODG1", "PRODUCT_ID"} if params.get("flagMergeAllProdg1") == "1" else {"PRODUCT_ID"} if params.get("flagMergeAllProductId") == "1" else set()
    if params.get("flagMergeAllChamber") == "1":
        dropped.add("CHAMBER_NAME")
    return tuple(k for k in default if k not in dropped), frozenset(dropped)


def _of(request_id: str, source: str, granularity: str, params: Mapping[str, Any], default: tuple[str, ...]) -> Request:
    keys, void = group_keys(params, default)
    merges = {c: tuple(tuple(map(str, rule)) for rule in params[f]) for f, c in MERGES.items() if params.get(f) and c not in void}
    filters = {c: _split(params.get(f)) for f, c in FILTERS.items() if params.get(f)}
    dates = params.get("dateRange") or {}
    ranges = tuple((r.get("start"), r.get("end")) for r in (dates if isinstance(dates, list) else [dates])) or ((None, None),)
    zones = {label: {z: tuple(s) for z, s in own.items()} for label, own in (params.get("modeInfo") or {}).items()}
    model = params.get("model") or "anova"
    if model not in MODELS:
        raise RequestError(f"unknown model: {model}")
    return Request(request_id, source, granularity, params.get("uploadId"), keys, merges, filters, ranges, _split(params.get("goodSite")), _split(params.get("badSite")), zones, model=model, item_type=params.get("itemType"), filter_upload_id=params.get("correlation_filter_upload_id"))


def parse(text: str) -> Request:
    try:
        body = json.loads(text)
    except json.JSONDecodeError as e:
        raise RequestError(f"no JSON at line {e.lineno}, column {e.colno}: {e.msg}") from e
    source, granularity = algorithm_of(body.get("algorithm"))
    params = body.get("requestParam") or {}
    default = {"defect": ("PRODG1", "PRODUCT_ID", "LAYER_ID"), "fdc_advanced": ("OPE_NO", "CHAMBER_NAME")}.get(source, DEFAULT_KEYS if source == "uva" else ("PRODG1", "PRODUCT_ID", "OPE_NO"))
    request = _of(str(body.get("requestId")), source, granularity, params, default)
    if not request.upload_id:
        raise RequestError("uploadId is missing")
    if source == "correlation":
        keys = {"uva": DEFAULT_KEYS, "inline": ("PRODG1", "PRODUCT_ID", "OPE_NO"), "wat": ("PRODG1", "PRODUCT_ID"), "process": ("PRODG1", "PRODUCT_ID", "EQP_NAME", "CHAMBER_NAME"), "qtime": ("PRODG1", "PRODUCT_ID", "OPE_NO")}
        parts = {s: _of(request.request_id, s, granularity, params[s], k) for s, k in keys.items() if params.get(s) is not None}
        if not parts:
            raise RequestError("a correlation needs at least one source")
        request = Request(**{**request.__dict__, "parts": parts})
    return request
