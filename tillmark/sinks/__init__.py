"""Writers: CSV, reports, table layouts, table versions and the monthly report job."""
