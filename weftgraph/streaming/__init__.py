from weftgraph.streaming.requests_stream import check_requests, completion_records, process_batch, run_stream

__all__ = ["check_requests", "completion_records", "process_batch", "run_stream"]
