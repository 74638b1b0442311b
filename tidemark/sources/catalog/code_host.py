"""Tables of a GitHub account: issues, repositories, pull requests and their children.

Repository scope (`owner`, `repo`) and the parent number of a review are landed as
columns beside the payload; a record itself does not have them.
"""

from tidemark.model import APPEND, CDC, SNAPSHOT, TableDef
from tidemark.sources.catalog.fields import fields

# Nested types and table schemas, keys, cursors and modes.
_NESTED = {
    "user": fields("login id:long node_id type site_admin:boolean"),
    "label": fields("id:long node_id name color description default:boolean"),
    "milestone": fields("id:long number:long title description state created_at updated_at due_on"),
    "permissions": fields("admin:boolean push:boolean pull:boolean"),
    "license": fields("key name spdx_id url node_id"),
    "template": fields("id:long node_id name full_name"),
    "commit_ref": fields("sha url"),
}

_SCHEMAS = {
    "issues": """id:long! node_id number:long! repository_owner! repository_name! title body state
        locked:boolean comments:long created_at updated_at closed_at author_association url html_url
        labels_url comments_url events_url timeline_url state_reason user:user assignee:user
        assignees:[user] labels:[label] milestone:milestone pull_request:map reactions:map""",
    "repositories": """id:long! node_id repository_owner! repository_name! name full_name owner:user
        private:boolean html_url description fork:boolean url
        archive_url assignees_url blobs_url branches_url collaborators_url comments_url commits_url compare_url
        contents_url contributors_url deployments_url downloads_url events_url forks_url git_commits_url
        git_refs_url git_tags_url git_url issue_comment_url issue_events_url issues_url keys_url labels_url
        languages_url merges_url milestones_url notifications_url pulls_url releases_url ssh_url stargazers_url
        statuses_url subscribers_url subscription_url tags_url teams_url trees_url clone_url mirror_url
        hooks_url svn_url
        homepage language forks_count:long stargazers_count:long watchers_count:long size:long
        default_branch open_issues_count:long is_template:boolean topics:[string] has_issues:boolean
        has_projects:boolean has_wiki:boolean has_pages:boolean has_downloads:boolean archived:boolean
        disabled:boolean visibility pushed_at created_at updated_at permissions:permissions
        allow_rebase_merge:boolean template_repository:template temp_clone_token
        allow_squash_merge:boolean allow_merge_commit:boolean subscribers_count:long network_count:long
        license:license""",
    "pull_requests": """id:long! node_id number:long! repository_owner! repository_name! state title body
        draft:boolean created_at updated_at closed_at merged_at merge_commit_sha user:user base:map
        head:map html_url url""",
    "comments": """id:long! node_id repository_owner! repository_name! issue_url html_url body user:user
        created_at updated_at author_association""",
    "commits": """sha! node_id repository_owner! repository_name! commit_message commit_author_name
        commit_author_email commit_author_date commit_committer_name commit_committer_email
        commit_committer_date html_url url author:user committer:user""",
    "users": """id:long! login! node_id type site_admin:boolean name company blog location email
        created_at updated_at""",
    "organizations": """id:long! login! node_id url repos_url events_url hooks_url issues_url members_url
        public_members_url avatar_url description""",
    "teams": "id:long! node_id organization_login! name slug description privacy permission",
    "assignees": "repository_owner! repository_name! login! id:long! node_id type site_admin:boolean",
    "collaborators": """repository_owner! repository_name! login! id:long! node_id type
        site_admin:boolean permissions:permissions""",
    "branches": """repository_owner! repository_name! name! commit:commit_ref protected:boolean
        protection_url""",
    "reviews": """id:long! node_id repository_owner! repository_name! pull_number:long! state body
        user:user commit_id submitted_at html_url""",
}
_IN_REPOSITORY = ("repository_owner", "repository_name")
_FLOWS = {
    "issues": (CDC, ("id",), "updated_at"),
    "repositories": (SNAPSHOT, ("id",), None),
    "pull_requests": (CDC, ("id",), "updated_at"),
    "comments": (CDC, ("id",), "updated_at"),
    "commits": (APPEND, ("sha",), None),
    "users": (SNAPSHOT, ("id",), None),
    "organizations": (SNAPSHOT, ("id",), None),
    "teams": (SNAPSHOT, ("id",), None),
    "assignees": (SNAPSHOT, (*_IN_REPOSITORY, "id"), None),
    "collaborators": (SNAPSHOT, (*_IN_REPOSITORY, "id"), None),
    "branches": (SNAPSHOT, (*_IN_REPOSITORY, "name"), None),
    "reviews": (APPEND, ("id",), None),
}
_PATHS = {
    "repositories": {"repository_owner": "owner.login", "repository_name": "name"},
    "commits": {"commit_message": "commit.message"}
    | {
        f"commit_{who}_{what}": f"commit.{who}.{what}"
        for who in ("author", "committer")
        for what in ("name", "email", "date")
    },
    "teams": {"organization_login": "organization.login"},
}


def _scope(table: str) -> dict[str, str]:
    if table in ("repositories", "users", "organizations", "teams"):
        return {}
    scope = {"repository_owner": "owner", "repository_name": "repo"}
    return scope | {"pull_number": "pull_number"} if table == "reviews" else scope


TABLES = {
    name: TableDef(
        name,
        fields(text, _NESTED),
        keys=_FLOWS[name][1],
        cursor=_FLOWS[name][2],
        mode=_FLOWS[name][0],
        paths=_PATHS.get(name, {}),
        scope=_scope(name),
        required=("owner", "repo") if _scope(name) else (),
        one_of=("owner", "org") if name == "repositories" else (),
    )
    for name, text in _SCHEMAS.items()
}
