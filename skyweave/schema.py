"""Declared schemas of the landed tables; nothing is inferred."""

EXTENT = "struct<west:double,east:double,south:double,north:double>"

RAW_SCAN = f"""
  source string, product string, ts_raw string, path string, height int, width int, is_u8 boolean,
  raw array<int>, what_data map<string,string>, what_dataset map<string,string>,
  what_global map<string,string>, where_attrs map<string,string>, date string
"""

CATALOG = "source string, product string, timestamp string, path string, url string, cached boolean, success boolean, error string"

STORE = f"""
  source string, product string, timestamp string, dimensions struct<height:int,width:int>, data array<float>,
  extent {EXTENT}, projection struct<type:string,proj_def:string,where_attrs:map<string,string>>,
  lons array<double>, lats array<double>, source_metadata map<string,string>, cached_at timestamp, bytes bigint
"""

ATTEMPTS = "source string, seq bigint, ok boolean, error string"
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
