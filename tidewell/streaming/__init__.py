"""Structured Streaming helpers: micro-batch runner, triggers, lifecycle."""

from .runner import (await_all, await_done, batch_scope, current_run_id, light_checkpoints,  # noqa: F401
                     run_batches, stop_queries, trigger_args)
