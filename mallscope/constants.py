"""Values the results share with the application being rebuilt.

Fixed values (must stay equal for equal results), in the order the
results use them:
"""

# --- fixed values -----------------------------------------------------------
TOP_CATEGORIES = 10                 # R1: hot categories kept
TOP_SESSIONS = 10                   # R2: sessions kept per hot category
TOP_PRODUCTS = 3                    # R4: products kept per area (rank, ties kept)
TOP_CITIES = 2                      # R4: cities named in the share text
OTHER_LABEL = "其他"                 # R4: label of the remainder entry of the share text
AD_LINE_FIELDS = ["timestamp", "area", "city", "userid", "adid"]   # stream line, space separated
BLACKLIST_THRESHOLD = 50            # R5: clicks of one user on one ad in one day that block the user
TOP_ADS = 3                         # R7: ads kept per (date, area)
TREND_SPAN_MINUTES = 3              # R8: trailing span of the per-minute trend
TOP3_KEY_PREFIX = "top3_ads_per_day:"                              # R7: hash key of a date
TREND_KEY = "last_hour_ads_click"                                  # R8: hash key of the trend
BATCH_INTERVAL = "3 seconds"        # stream micro-batch interval
RESULT_TABLES = {"r1": "category_top10", "r2": "category_session_top10",
                 "r3": "jump_page_ratio", "r4": "area_count_info"}
# ----------------------------------------------------------------------------
