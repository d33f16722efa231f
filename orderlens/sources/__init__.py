"""Sources and sinks."""

from .store import (load_model, materialize, new_work_path, read_recommendations,
                    read_recommendations_csv, read_split, save_model, work_dir,
                    write_recommendations, write_recommendations_csv, write_splits)
from .tables import (SCORE_REQUEST_SCHEMA, Tables, base_schemas, jdbc_options, load_tables,
                     tables_from_star_schema)

__all__ = ["SCORE_REQUEST_SCHEMA", "Tables", "base_schemas", "jdbc_options", "load_model",
           "load_tables", "materialize", "new_work_path", "read_recommendations",
           "read_recommendations_csv", "read_split", "save_model", "tables_from_star_schema",
           "work_dir", "write_recommendations", "write_recommendations_csv", "write_splits"]
