from dimsmith.sources import feeds, model, sinks, testdata

__all__ = ["feeds", "model", "sinks", "testdata"]
