"""stratus — surface-weather (SYNOP) analytics as Spark DataFrame jobs.

Stages, all DataFrame in / DataFrame out:

* ``stratus.sources``   landed raw replies, undecoded report CSVs, station
  tables and decoded observation folders;
* ``stratus.operators`` record preparation, the SYNOP decode as native column
  expressions, cleaning, aggregates, chart data and reporting coverage;
* ``stratus.plans``     whole jobs (decode, analysis) built from the above;
* ``stratus.streaming`` the same row-wise decode over files as they land;
* ``stratus.sinks``     CSV / Parquet writers and run counts.
"""

from stratus.session import build_session, checkpoint_dir

# Main entry points, loaded on first use so ``import stratus`` stays light.
_EXPORTS = {
    "decode_reports": "stratus.operators.decode",
    "prepare_records": "stratus.operators.prepare",
    "attach_coordinates": "stratus.operators.prepare",
    "clean_observations": "stratus.operators.clean",
    "decode_raw": "stratus.plans.decode_job",
    "run_decode": "stratus.plans.decode_job",
    "run_analysis": "stratus.plans.analysis_job",
    "analyse_decoded": "stratus.plans.analysis_job",
    "analyse_decoded_csv": "stratus.plans.analysis_job",
    "analyse_raw": "stratus.plans.analysis_job",
    "read_replies": "stratus.sources.raw_reply",
    "read_undecoded_csv": "stratus.sources.undecoded",
    "read_station_csv": "stratus.sources.stations",
    "read_observations": "stratus.sources.observations",
    "append_clustered": "stratus.sources.clustered",
    "read_clustered": "stratus.sources.clustered",
    "footer_counts": "stratus.sources.clustered",
    "period_coverage": "stratus.operators.coverage",
    "start_decode_stream": "stratus.streaming.landed",
}


def __getattr__(name):
    if name in _EXPORTS:
        import importlib

        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module 'stratus' has no attribute {name!r}")


__all__ = ["build_session", "checkpoint_dir", *_EXPORTS]
__version__ = "0.1.0"
