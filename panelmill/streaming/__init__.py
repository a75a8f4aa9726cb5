from panelmill.streaming.ingest import run_stream

__all__ = ["run_stream"]
