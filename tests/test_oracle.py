import pytest
from oracle_check import SF, compare, connect

from fundalake.plans import registry

#: One query or more of each group; the driver runs all of them.
NAMES = "scan_prices scan_financials scan_macro scan_dividends scan_shares scan_status scan_metadata scan_sectors csv_sink catalog store_sql table_refresh stream_ingest ticker_ciks primary_tickers select_mi asof_macro store_filtered catalog_schemas prepare_features aligned_split scan_dividends_csv merge_shares random_split walk_forward class_report score_areas corr_pearson corr_target corr_high describe_by_group histogram_grid violin heatmap_group scatter_points classify_period dedup_facts fill_filing_date macro_pivot upsert table_stats filtered_prices companyfacts_flatten merge_facts share_history calculated_shares share_counts filing_status status_table filing_dates ticker_list ohlcv_long high_water_mark covered_delisted series_merge jsonstat report_page_facts period_header local_number facts_filled ytd_to_discrete year_complete mixed_quarters snapshot_to_flow financials_wide shares_clean macro_normalized asof_backward ttm master_dataset bankruptcy_dataset label_stats altman rolling_trends time_split describe quality_summary outliers_iqr corr_spearman corr_kendall box_by_sector filter_ops scan preset_turnaround scan_indicator sector_ranking ticker_profile".split()


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    compare(registry.queries()[name](spark, SF), registry.oracle_sql()[name], con)


def test_entry_works_without_llm(spark):
    import __spark_entry__ as e

    assert set(registry.queries()) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.entry(spark).columns) == 88
