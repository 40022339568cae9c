"""Names, word lists and rules that results depend on.

Nothing here is logic. Every list is in the order in which it is published or
evaluated, because that order is part of the result.
"""

from __future__ import annotations

# --- Event categories: code prefix -> (parent code, parent name) -------------
CATEGORY_BY_PREFIX = {
    "USR": ("USR", "USER ACTIVITY"),
    "AUTHZ": ("AUTHZ", "ACCESS CONTROL"),
    "CONN": ("CONN", "SAML CONNECTION"),
    "INT": ("INT", "INTEGRATION"),
    "FRCST": ("FRCST", "FORECASTER"),
    "PIQ": ("PIQ", "PLANIQ"),
    "WF": ("WF", "WORKFLOW"),
    "DSM": ("DSM", "ENCRYPTION ACTIVITY"),
    "OAUTH": ("OAUTH", "OAUTH"),
    "COMMENT": ("COMMENT", "COMMENT"),
}
UNCATEGORIZED = ("UNCAT", "UNCATEGORIZED")
CATEGORY_ROOT = "All Events"
CATEGORY_LIST_ORDER = [
    "AUTHZ", "CONN", "DSM", "INT", "PIQ", "FRCST", "USR", "WF", "OAUTH", "COMMENT", "UNCAT",
]

# --- Attribute keys lifted to named columns ----------------------------------
ATTRIBUTE_COLUMNS = {
    "appId": "app_id",
    "appName": "app_name",
    "pageId": "page_id",
    "pageName": "page_name",
    "integrationId": "integration_id",
    "integrationName": "integration_name",
    "integrationFlowId": "integration_flow_id",
    "actionId": "action_id",
    "actionName": "action_name",
    "actionType": "action_type",
    "processId": "process_id",
    "processName": "process_name",
    "roleId": "role_id",
    "roleName": "role_name",
    "targetUserId": "target_user_id",
    "targetUserName": "target_user_name",
}
RAW_ATTRIBUTES_COLUMN = "additional_attributes_raw"
CATEGORY_ATTRIBUTES = {
    "uxAppPage": ["app_id", "app_name", "page_id", "page_name"],
    "cwIntegration": ["integration_id", "integration_name", "integration_flow_id"],
    "action": ["action_id", "action_name", "action_type"],
    "process": ["process_id", "process_name"],
    "role": ["role_id", "role_name"],
    "targetUser": ["target_user_id", "target_user_name"],
}
DEFAULT_ENABLED_CATEGORIES = ["uxAppPage", "cwIntegration", "action", "process"]
DEFAULT_LIST_CATEGORIES = ["uxAppPage"]

# --- Dimension lists: name -> (category, code column, name column, parent) ---
ATTRIBUTE_LISTS = {
    "ux_app": ("uxAppPage", "app_id", "app_name", None),
    "ux_page": ("uxAppPage", "page_id", "page_name", "app_id"),
    "cw_integration": ("cwIntegration", "integration_id", "integration_name", None),
    "action": ("action", "action_id", "action_name", None),
    "process": ("process", "process_id", "process_name", None),
    "role": ("role", "role_id", "role_name", None),
    "target_user": ("targetUser", "target_user_id", "target_user_name", None),
}

# --- Labels of the wide audit table ------------------------------------------
UNSAVED_ACTION_ID = "-1"
UNSAVED_ACTION_LABEL = "Unsaved Action"
DELETED_OBJECT_LABEL = "<Object has been Deleted>"
OBJECT_LABEL_MODEL = "Model"
OBJECT_LABEL_INTEGRATION = "CloudWorks Integration"
OBJECT_LABEL_USER = "User"

# --- Attribute columns of the wide audit table: output -> attribute key ------
WIDE_ATTRIBUTES = {
    "ADDITIONAL_ATTRIBUTES_NAME": "name",
    "ADDITIONAL_ATTRIBUTES_TYPE": "type",
    "ADDITIONAL_ATTRIBUTES_AUTH_ID": "auth_id",
    "MODEL_ROLE_NAME": "modelRoleName",
    "MODEL_ROLE_ID": "modelRoleId",
    "ADDITIONAL_ATTRIBUTES_OBJECT_TYPE_ID": "objectTypeId",
    "ADDITIONAL_ATTRIBUTES_ROLE_ID": "roleId",
    "ADDITIONAL_ATTRIBUTES_ROLE_NAME": "roleName",
    "ADDITIONAL_ATTRIBUTES_OBJECT_TENANT_ID": "objectTenantId",
    "ADDITIONAL_ATTRIBUTES_OBJECT_ID": "objectId",
    "ADDITIONAL_ATTRIBUTES_ACTIVE": "active",
    "UX_APP_ID": "appId",
    "UX_APP_NAME": "appName",
    "UX_PAGE_ID": "pageId",
    "UX_PAGE_NAME": "pageName",
    "ADO_PIPELINE_ID": "pipelineId",
    "ADO_DATASPACE_ID": "dataspaceId",
    "ADO_SCHEDULE_ID": "scheduleId",
    "ADO_CONNECTION_ID": "connectionId",
    "WORKFLOW_TASK_ID": "taskId",
    "WORKFLOW_TEMPLATE_ID": "workflowTemplateId",
    "COMMENT_ID": "commentId",
}

# --- The 59 columns of the wide audit table, in published order --------------
WIDE_COLUMNS = [
    "LOAD_ID", "BATCH_ID", "AUDIT_ID", "EVENT_DATE", "EVENT_TIMEZONE", "CREATED_DATE",
    "CREATE_TIMEZONE", "EVENT_ID", "EVENT_MESSAGE", "ASSOCIATED_OBJECT_ID", "NOTES", "USER_ID",
    "USER_NAME", "DISPLAY_NAME", "TENANT_ID", "TENANT_NAME", "WORKSPACE_ID", "WORKSPACE_NAME",
    "MODEL_ID", "MODEL_NAME", "OBJECT_ID", "OBJECT_TYPE", "OBJECT_NAME", "MESSAGE", "SUCCESS",
    "ERROR_NUMBER", "IP_ADDRESS", "USER_AGENT", "SESSION_ID", "HOST_NAME", "SERVICE_VERSION",
    "OBJECT_TYPE_ID", "OBJECT_TENANT_ID", "ACTION_ID", "ACTION_NAME", *WIDE_ATTRIBUTES,
    "EVENT_CATEGORY", "CHECKSUM",
]

# --- Catalogue of event codes ------------------------------------------------
CATALOG_COLUMNS = ["Event Code", "Event Message", "Associated Object ID", "Notes"]
MAX_EVENT_NAME_LENGTH = 60

# --- Change-history table ----------------------------------------------------
HISTORY_COLUMNS = [
    "record_id",
    "source_record_id",
    "model_id",
    "date_time_utc",
    "user",
    "description",
    "security_change",
    "previous_value",
    "new_value",
    "module_list",
    "line_item_property",
    "customer",
    "export",
    "import_action",
    "data_types",
    "table_name",
    "object",
    "target_user",
    "captured_at",
    "change_type",
    "object_type",
]
# Target column -> lower-case parts of a header, in claiming order.
HEADER_PATTERNS = {
    "description": ["description"],
    "previous_value": ["previous value", "before"],
    "new_value": ["new value", "after"],
    "security_change": ["security change", "security", "role"],
    "module_list": ["module/list", "module list", "module"],
    "line_item_property": ["line item/property", "line item", "property"],
    "customer": ["customer", "sku"],
    "export": ["export"],
    "import_action": ["import"],
    "data_types": ["data types", "data type"],
    "table_name": ["table name"],
    "object": ["object"],
    "target_user": ["target user", "targetuser"],
    "date_time_utc": ["date_time_utc", "date/time", "date time", "timestamp"],
    "user": ["user"],
}
EXACT_ID_HEADER = "ID"
INVALID_NAME_CHARACTERS = r'[/\\:*?"<>|]'

# --- Change classification ---------------------------------------------------
CATCHALL_OBJECT_TYPE = "Other"
CATCHALL_CHANGE_TYPE = "Model change (no details available)"
OBJECT_TYPES = [
    "Module/List", "Line Item/Property", "Customer", "Export", "Dashboard", "Action",
    "Process", "Version", "Time Settings", "User", "Role", "Other",
]
CHANGE_TYPES = [
    "<model successfully restored>", "Add", "Add Dashboard", "Add Export", "Add Functional Area", "Add Import",
    "Add Import Data Source", "Add Item", "Add Line Item",
    "Add Line Item Read Access Driver Write Access Driver", "Add List", "Add List Item", "Add Module",
    "Add Module Read Access Driver Write Access Driver", "Add Process", "Add Property", "Add Role",
    "Add Saved View", "Add Tag", "Add User", "Add Version", "Begin sync revision", "Blank Model Change",
    "Break-back data change", "Breakback data change affecting [x] cells", "Bulk data change",
    "Bulk data change (add-in)", "Bulk Model Change", "Change Dashboard", "Change Export", "Change Import",
    "Change Import Data Source", "Change Line Item", "Change List", "Change Module", "Change Process",
    "Change Property", "Change Saved View", "Change Time Scale", "Change Version", "Code Changed", "Create",
    "Create Dashboard", "Data Change", "Delete", "Delete Import", "Delete Import Data Source", "Delete Item",
    "Delete Line Item", "Delete List", "Delete Module", "Delete Property", "Delete Saved View", "Delete User",
    "Edit", "Edit Line Item", "Import", "Model change (no details available)", "Move Item", "Move Line Item",
    "Move Module", "Move Version", "Name Changed", "Other", "Other Change", "Parent Changed", "Rename",
    "Rename Action", "Revision Added Automatically", "Revision Added Manually by User", "Revision Synced",
    "Set Action Access", "Set List Access", "Set Module Access", "Set Selective Access",
    "Sync revision completed", "Sync revision unsuccessful", "Undo", "User Role Changed", "x Item(s) Added",
    "x Item(s) Deleted", "x User(s) Deleted",
]
# priority,pattern,object_type,change_type
RULES_CSV = r"""priority,pattern,object_type,change_type
50,^<model successfully restored>$,Other,<model successfully restored>
50,^Add Dashboard$,Dashboard,Add Dashboard
50,^Add Export$,Export,Add Export
50,^Add Functional Area$,Other,Add Functional Area
50,^Add Import$,Other,Add Import
50,^Add Import Data Source$,Other,Add Import Data Source
50,^Add Item$,Module/List,Add Item
50,^Add Line Item$,Line Item/Property,Add Line Item
50,^Add Line Item Read Access Driver Write Access Driver$,Line Item/Property,Add Line Item Read Access Driver Write Access Driver
50,^Add List$,Module/List,Add List
50,^Add List Item$,Module/List,Add List Item
50,^Add Module$,Module/List,Add Module
50,^Add Module Read Access Driver Write Access Driver$,Module/List,Add Module Read Access Driver Write Access Driver
50,^Add Process$,Process,Add Process
50,^Add Property$,Line Item/Property,Add Property
50,^Add Role$,Role,Add Role
50,^Add Saved View$,Other,Add Saved View
50,^Add Tag$,Other,Add Tag
50,^Add User$,User,Add User
50,^Add Version$,Version,Add Version
50,^Begin sync revision$,Other,Begin sync revision
50,^Blank Model Change$,Other,Blank Model Change
50,^Break-back data change$,Line Item/Property,Break-back data change
90,^Breakback data change affecting \d+ cells$,Line Item/Property,Breakback data change affecting [x] cells
50,^Bulk data change$,Line Item/Property,Bulk data change
50,^Bulk data change \(add-in\)$,Line Item/Property,Bulk data change (add-in)
50,^Bulk Model Change$,Other,Bulk Model Change
50,^Change Dashboard$,Dashboard,Change Dashboard
50,^Change Export$,Export,Change Export
50,^Change Import$,Other,Change Import
50,^Change Import Data Source$,Other,Change Import Data Source
50,^Change Line Item$,Line Item/Property,Change Line Item
50,^Change List$,Module/List,Change List
50,^Change Module$,Module/List,Change Module
50,^Change Process$,Process,Change Process
50,^Change Property$,Line Item/Property,Change Property
50,^Change Saved View$,Other,Change Saved View
50,^Change Time Scale$,Time Settings,Change Time Scale
50,^Change Version$,Version,Change Version
50,^Code Changed$,Line Item/Property,Code Changed
50,^Create Dashboard$,Dashboard,Create Dashboard
50,^Data Change$,Line Item/Property,Data Change
50,^Delete Import$,Other,Delete Import
50,^Delete Import Data Source$,Other,Delete Import Data Source
50,^Delete Item$,Module/List,Delete Item
50,^Delete Line Item$,Line Item/Property,Delete Line Item
50,^Delete List$,Module/List,Delete List
50,^Delete Module$,Module/List,Delete Module
50,^Delete Property$,Line Item/Property,Delete Property
50,^Delete Saved View$,Other,Delete Saved View
50,^Delete User$,User,Delete User
50,^Edit Line Item$,Line Item/Property,Edit Line Item
50,^Import$,Other,Import
50,^Move Item$,Module/List,Move Item
50,^Move Line Item$,Line Item/Property,Move Line Item
50,^Move Module$,Module/List,Move Module
50,^Move Version$,Version,Move Version
50,^Name Changed$,Other,Name Changed
50,^Other Change$,Other,Other Change
50,^Parent Changed$,Other,Parent Changed
50,^Rename Action$,Action,Rename Action
50,^Revision Added Automatically$,Other,Revision Added Automatically
50,^Revision Added Manually by User$,Other,Revision Added Manually by User
50,^Revision Synced$,Other,Revision Synced
50,^Set Action Access$,Action,Set Action Access
50,^Set List Access$,Module/List,Set List Access
50,^Set Module Access$,Module/List,Set Module Access
50,^Set Selective Access$,Role,Set Selective Access
50,^Sync revision completed$,Other,Sync revision completed
50,^Sync revision unsuccessful$,Other,Sync revision unsuccessful
50,^Undo$,Other,Undo
50,^User Role Changed$,Role,User Role Changed
90,^\d+ Item\(s\) Added$,Module/List,x Item(s) Added
90,^\d+ Item\(s\) Deleted$,Module/List,x Item(s) Deleted
90,^\d+ User\(s\) Deleted$,User,x User(s) Deleted
999,.*,Other,Model change (no details available)
"""

# --- Publishing --------------------------------------------------------------
COUNTER_COLUMNS = {
    "workspaces": "WS_CT",
    "users": "USR_CT",
    "models": "MOD_CT",
    "actions": "ACT_CT",
    "files": "FILE_CT",
    "cloudworks": "CW_CT",
}
PUBLISHED_METADATA = [
    "workspaces", "users", "models", "actions", "files", "cloudworks", "act_codes",
    "event_categories",
]
RETENTION_DAYS_PER_YEAR = 365
EVENTS_SCHEMA_VERSION = 2
