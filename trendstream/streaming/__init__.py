"""Structured Streaming: runner, stream stages, jobs, stateful new-alert stream, watcher."""
