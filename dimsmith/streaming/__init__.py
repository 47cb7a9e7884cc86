from dimsmith.streaming import change_task, incremental

__all__ = ["change_task", "incremental"]
