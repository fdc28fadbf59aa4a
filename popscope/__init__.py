"""Sampling, profiling and exact vector search over large population tables."""

from popscope.functions.encoders import Encoder, NgramEncoder
from popscope.operators.encode import encode_passages, encode_queries, encode_query, pack, unpack
from popscope.operators.filtering import count_matching, matching
from popscope.operators.lookup import duplicate_ids, get_by_id, get_by_ids
from popscope.operators.profile import describe_filters
from popscope.operators.sampling import panel, panel_late, sample, sample_late
from popscope.operators.search import (
    hydrate,
    search,
    search_late,
    vector_scores,
    vector_topk,
    vector_topk_batch,
)
from popscope.operators.stats import stats
from popscope.plans.first_rows import first_rows
from popscope.plans.index_build import BuildReport, build_index
from popscope.settings import SETTINGS
from popscope.shipping import ship_package
from popscope.sources.population import (
    DatasetMissingError,
    dataset_inventory,
    open_population,
    rows_as_json,
    table_inventory,
    write_json,
)
from popscope.sources.vector_index import IndexMissingError, index_info, open_index
from popscope.spec import (
    ColumnRole,
    Dimension,
    PopulationSpec,
    categorical,
    freetext,
    number_range,
)
from popscope.streaming.index_stream import publish_stream, start_index_stream

__all__ = [name for name in dir() if not name.startswith("_")]
