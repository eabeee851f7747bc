"""eventflow: clean, parse, enrich and filter log and event data with Spark."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

from .operators.alerts import check_points, failure_alerts, failure_rate
from .operators.dates import date_parse
from .operators.enrich import dns, enricher, geoip, useragent
from .operators.fields import (
    add_field,
    fingerprint,
    json_flatten,
    passthrough,
    regex_replace,
    remove_field,
    rename_field,
    uppercase_keys,
)
from .operators.grok import grok
from .operators.kv import kv
from .operators.mutate import mutate
from .operators.parse import parse
from .operators.predicates import conditional, conditional_field, drop, exclude, include, json_validate, sample
from .operators.rows import head_sample, split
from .operators.summary import (
    dataset_metrics,
    filter_stats,
    processing_stats,
    schema_profile,
    schema_union,
    transformation_summary,
)
from .plans.chain import preview, route, run_pipeline, run_pipeline_audited
from .plans.merged import route_once
from .plans.spec import as_spec, default_spec, register_filter, register_parser, validate_spec
from .session import RECOMMENDED_CONF, configure, scratch_dir
from .sources.delimited import read_delimited_records
from .sources.events import parse_by_hint, promote, read_delimited, read_events, read_events_stream, read_lines
from .sources.paths import select_source_files, with_format_hint, with_path_metadata
from .sources.sinks import manifest, route_errors, split_errors, write_events, write_events_stream, write_manifest

# Python functions travel to the executors with their code, so those need no copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

__all__ = [name for name in dir() if not name.startswith("_")]
