"""ember: Spark-native ratings, retail and frame-stream operators.

Modules:
    session      -- session defaults, input-sized shuffle config, shared scratch folder
    schemas      -- declared schemas (frame packets, messages, images, text layouts)
    functions    -- column expressions (parsing, buckets, text formats, base64, file names)
    sources      -- file readers (text with quarantine, CSV, images) and the driver's tables
    operators    -- ratings, report, retail, packets, quality, metrics, frames, skew
    streaming    -- message sources, foreachBatch writer, progress, the frame job
    sinks        -- keyed frame output
    plans        -- the registered queries and their DuckDB oracles

Every operator takes DataFrames and returns a DataFrame; nothing is collected.
"""
