"""Names and constants the results depend on.

Fixed values: everything in this module has to be equal to what users of the
churn tables rely on (column names and their order, thresholds, bucket bounds,
reason texts), so it is stated as plain text in one place.
"""

from __future__ import annotations

import datetime as dt

# --- fixed values: the feature view ---------------------------------------
DEMOGRAPHICS = ["city", "bd", "gender", "registered_via"]

NUMERIC_FEATURES = [
    "total_transactions",
    "total_amount_paid",
    "avg_amount_paid",
    "auto_renew_count",
    "cancel_count",
    "total_log_days",
    "total_secs",
    "avg_daily_secs",
    "total_num_25",
    "total_num_50",
    "total_num_75",
    "total_num_985",
    "total_num_100",
    "total_num_unq",
]

FEATURES = DEMOGRAPHICS + NUMERIC_FEATURES
LABEL = "is_churn"
NON_FEATURES = ["msno", "registration_init_time", "latest_expire_date", "event_timestamp"]
FEATURE_TTL = dt.timedelta(days=30)

# --- fixed values: preparation and scoring --------------------------------
GENDER_CODES = {"male": 0, "female": 1, "unknown": 2}
OTHER_GENDER_CODE = 2
SPLIT_DATE = dt.date(2016, 6, 1)
CHURN_THRESHOLD = 0.781
TOP_REASONS = 3
CHURN_HISTORY_SIZE = 2000
CHURNED_LIST_SIZE = 500

# --- fixed values: streaming ----------------------------------------------
LOG_TOPIC = "user_logs"
TRANSACTION_TOPIC = "transactions"
MARKER_KEY = "__eod__"
STREAM_START = dt.date(2017, 3, 1)
REPLAY_DAYS = 31

# --- fixed values: drift ---------------------------------------------------
HISTOGRAM_BINS = 10
PSI_EPSILON = 1e-6
PSI_WARNING = 0.10
PSI_CRITICAL = 0.25
KS_ALPHA = 0.05

# --- fixed values: serving histograms --------------------------------------
LATENCY_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]
FETCH_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0]
PROBABILITY_BUCKETS = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
BATCH_SIZE_BUCKETS = [1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0, 1000.0]
SCRAPE_SECONDS = 15

# --- fixed values: default model parameters --------------------------------
BOOSTED_TREES = {
    "n_estimators": 500,
    "max_depth": 6,
    "learning_rate": 0.05,
    "subsample": 0.8,
    "colsample": 0.8,
    "min_child_weight": 10,
    "random_state": 42,
    "patience": 30,
}

# --- fixed values: reason texts --------------------------------------------
# feature: (text when the user is predicted to churn, text when predicted to stay)
REASON_TEXTS = {
    "cancel_count": ("Khách hàng đã hủy gói nhiều lần", "Số lần hủy gói đang tăng — cần theo dõi"),
    "total_log_days": ("Khách hàng ít hoạt động trên nền tảng", "Mức độ hoạt động đang có dấu hiệu giảm"),
    "total_secs": ("Tổng thời gian nghe nhạc thấp", "Thời gian nghe nhạc đang giảm đáng kể"),
    "avg_daily_secs": ("Thời gian nghe nhạc hàng ngày thấp", "Thời gian nghe nhạc hàng ngày đang giảm"),
    "auto_renew_count": ("Khách hàng ít tự động gia hạn gói", "Tỉ lệ tự động gia hạn đang giảm"),
    "total_transactions": ("Ít giao dịch thanh toán được thực hiện", "Số lần giao dịch đang giảm"),
    "total_amount_paid": ("Tổng số tiền đã thanh toán thấp", "Giá trị thanh toán tổng đang giảm"),
    "avg_amount_paid": ("Giá trị giao dịch trung bình thấp", "Giá trị mỗi giao dịch đang giảm"),
    "total_num_unq": ("Ít bài hát khác nhau được nghe", "Đa dạng bài hát đang giảm"),
    "total_num_100": ("Ít bài hát được nghe hoàn toàn", "Ít nghe hết bài hơn trước"),
    "total_num_25": ("Phần lớn bài hát bị bỏ ngang từ đầu", "Xu hướng bỏ bài từ đầu đang tăng"),
    "total_num_50": ("Nhiều bài hát bị bỏ giữa chừng", "Xu hướng bỏ bài giữa chừng đang tăng"),
    "total_num_75": ("Nhiều bài hát không nghe đến cuối", "Ít nghe đến cuối bài hơn trước"),
    "total_num_985": ("Ít bài hát được nghe gần hết", "Mức độ tương tác với bài hát đang giảm"),
    "city": ("Khu vực địa lý có tỉ lệ churn cao", "Khu vực có xu hướng churn tăng gần đây"),
    "registered_via": ("Kênh đăng ký có tỉ lệ churn cao", "Kênh đăng ký có dấu hiệu churn tăng"),
    "bd": ("Nhóm tuổi có tỉ lệ churn cao", "Nhóm tuổi đang có tỉ lệ rời bỏ cao hơn"),
    "gender": ("Nhóm giới tính có tỉ lệ churn cao", "Nhóm giới tính đang có tỉ lệ rời bỏ cao hơn"),
}
