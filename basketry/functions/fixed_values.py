"""Texts, lookup entries and thresholds that results must carry unchanged."""

# --- fixed values: alert advice by alert type, and the default advice --------
ADVICE = {
    "DATA_DRIFT": """
1. Проверьте источник данных на изменения в пайплайне
2. Проанализируйте дрейфующие признаки
3. Рассмотрите обновление эталонных данных
4. При необходимости запустите переобучение модели
            """,
    "ACCURACY_DROP": """
1. Проверьте качество входных данных
2. Проанализируйте ошибки классификации
3. Изучите распределение предсказаний
4. Рассмотрите возможность retrain модели
            """,
    "CONCEPT_DRIFT": """
1. Проведите анализ изменений в бизнес-процессах
2. Проверьте релевантность признаков
3. Обновите тренировочные данные
4. Запланируйте переобучение модели
            """,
    "MISSING_VALUES": """
1. Проверьте источники данных на сбои
2. Настройте обработку пропусков в пайплайне
3. Убедитесь в корректности ETL процессов
            """,
    "PREDICTION_DRIFT": """
1. Проверьте распределение входных данных
2. Проанализируйте изменения в пороге классификации
3. Изучите сдвиги в предсказаниях по сегментам
            """,
}
DEFAULT_ADVICE = """
1. Проверьте логи мониторинга
2. Проанализируйте метрики в MLflow
3. Изучите дашборды дрейфа
        """

# --- fixed values: alert colours --------------------------------------------
LEVEL_COLOURS = {"CRITICAL": "#FF0000", "WARNING": "#FFA500", "INFO": "#36A64F"}
DEFAULT_COLOUR = "#808080"

# --- fixed values: labels of the alert text ----------------------------------
ALERT_TITLE = "🚨 *ML MONITORING ALERT* 🚨"
TIME_LABEL = "*Время:* "
LEVEL_LABEL = "*Уровень:* "
TYPE_LABEL = "*Тип:* "
MESSAGE_LABEL = "*Сообщение:* "
METRIC_LABEL = "*Метрика:* "
VALUE_LABEL = "*Текущее значение:* "
THRESHOLD_LABEL = "*Порог:* "
CONTEXT_LABEL = "*Контекст:*"
ADVICE_LABEL = "*Рекомендации:*"

# --- fixed values: messages of the monitoring alerts (printf patterns) --------
DRIFT_MESSAGE = "Обнаружен значительный дрейф данных! PSI: %.3f > %s"
COLUMN_DRIFT_MESSAGE = "Дрейф обнаружен в %s колонках"
MISSING_MESSAGE = "Высокий процент пропусков: %.3f > %s"
RANGE_MESSAGE = "Нарушение диапазонов значений в %s колонках"
ACCURACY_MESSAGE = "Низкая accuracy: %.3f"
F1_MESSAGE = "Низкий F1-score: %.3f"
RETRAIN_DRIFT_MESSAGE = "Data drift превысил порог: %.3f > %s"
RETRAIN_ACCURACY_MESSAGE = "Падение accuracy превысило порог: %.3f > %s"
RETRAIN_WEEKLY_MESSAGE = "Запланированный еженедельный retrain"
RETRAIN_AGE_MESSAGE = "Модель слишком старая: %s дней > %s"
RETRAIN_NEW_DATA_MESSAGE = "Достаточно новых данных для retrain: %s samples"

# --- fixed values: thresholds -------------------------------------------------
PSI_LIMIT = 0.2
KS_LIMIT = 0.1
JS_LIMIT = 0.1
SIGNIFICANCE = 0.05
MISSING_LIMIT = 0.1
CONCEPT_LIMIT = 0.3
ACCURACY_FLOOR = 0.8
F1_FLOOR = 0.7
METRIC_DROP_LIMITS = {
    "accuracy": 0.1,
    "precision": 0.15,
    "recall": 0.15,
    "f1_score": 0.1,
    "roc_auc": 0.05,
}
RETRAIN_DRIFT_LIMIT = 0.3
RETRAIN_ACCURACY_LIMIT = 0.15
RETRAIN_WEEKDAY = 0
RETRAIN_MIN_INTERVAL_DAYS = 7
RETRAIN_MAX_AGE_DAYS = 30
RETRAIN_MIN_NEW_ROWS = 1000
UNKNOWN_MODEL_AGE_DAYS = 365

# --- fixed values: alert groups and their channels ----------------------------
ALERT_GROUPS = {
    "data_drift": {
        "enabled": True,
        "channels": ["slack", "email"],
    },
    "model_performance": {
        "enabled": True,
        "channels": ["slack"],
    },
    "retrain": {
        "enabled": True,
        "channels": ["slack", "email"],
    },
    "system": {
        "enabled": True,
        "channels": ["slack"],
    },
}

# --- fixed values: error categories, in test order ------------------------------
ERROR_CATEGORIES = ["timeout", "connection_error", "server_error", "client_error", "other"]

# --- fixed values: feature columns of the purchase model, in order -----------------
MODEL_FEATURES = [
    "price", "hour", "day_of_week", "day_of_month", "is_weekend",
    "brand_freq", "category_id_freq", "product_id_freq",
    "user_price_mean", "user_price_std", "user_event_count",
    "user_purchase_count", "user_purchase_rate",
    "brand_is_popular", "category_id_is_popular", "product_id_is_popular",
]

# --- fixed values: feature columns of the demand model, in order --------------------
DEMAND_FEATURES = [
    "total_events", "views", "cart_adds", "unique_users", "avg_price", "price_std",
    "unique_sessions", "day_of_week", "is_weekend",
]

# Shadow comparison, fixed values: largest share of major discrepancies and of label mismatches.
SHADOW_READY = (0.01, 0.05)
SHADOW_TESTING = (0.05, 0.1)

# Canary, fixed values: latency ratios to the current model, and steps of the traffic share in percent.
CANARY_SLOWER = 1.2
CANARY_FASTER = 0.9
CANARY_MORE = 10
CANARY_LESS = 20
